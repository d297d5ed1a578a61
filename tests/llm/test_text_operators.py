"""Operators on single texts against plain forms: fingerprints, token counts and files, language, secrets, leaks."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from workdays.llm import decontaminate, fingerprints, language, secrets, token_counts, token_files, tokens
from workdays.llm.common import work_folder

from . import brute
from .conftest import pairs, prose

BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# -- fingerprints ------------------------------------------------------------------------------


def test_edited_texts_and_equal_fingerprints(docs):
    got = {r.doc_id: r for r in fingerprints.edited_pairs(docs).collect()}
    want = brute.edited(pairs(docs))
    assert {k: (r.n_chars, r.edited_sha256) for k, r in got.items()} == want
    assert got[17].fingerprint == got[18].fingerprint and got[0].fingerprint == got[1].fingerprint == ""
    assert got[17].near_next == 1.0 and got[0].near_next == 1.0 and got[1].near_next == 0.0
    assert all(0 <= x <= 1 for r in got.values() for x in (r.near_edited, r.near_next))


def test_likeness_estimates_jaccard():
    errors = []
    for seed in range(40):
        a = prose(seed, 300)
        b = a[: len(a) * 3 // 4] + prose(seed + 1000, 80)
        x, y = ({("\0" * 7 + t)[i : i + 8] for i in range(len(t))} for t in (a, b))
        errors.append(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.05


def test_densification_fills_every_bin_alike():
    few = np.concatenate(list(fingerprints.shingle_pieces("abc")))
    full = fingerprints.sketch([few])
    assert set(full.tolist()) <= set(few.tolist()) and len(full) == 1 << fingerprints.BINS_LOG2
    assert (full == fingerprints.sketch([few[::-1]])).all() and (full == fingerprints.sketch([few[1:], few[:1]])).all()
    assert fingerprints.sketch([]) is None and fingerprints.sketch([np.empty(0, np.uint64)]) is None


def test_long_texts_hash_alike_in_pieces(monkeypatch):
    text = prose(3, 2000)
    whole, print_ = np.concatenate(list(fingerprints.shingle_pieces(text))), fingerprints.fingerprint(text)
    for size in (1000, 5, 1):
        monkeypatch.setattr(fingerprints, "_PIECE", size)
        assert (np.concatenate(list(fingerprints.shingle_pieces(text))) == whole).all()
    assert fingerprints.fingerprint(text[:50]) == fingerprints.fingerprint(text[:50]) and len(whole) == len(text)
    monkeypatch.setattr(fingerprints, "_PIECE", 1000)
    assert fingerprints.fingerprint(text) == print_


def test_fingerprints_of_repeated_null_and_no_rows(odd, empty):
    got = fingerprints.edited_pairs(odd).collect()
    assert len(got) == odd.count() and sum(r.doc_id is None for r in got) == 2
    assert fingerprints.edited_pairs(empty).count() == 0 and fingerprints.fingerprints(empty).count() == 0
    one = fingerprints.edited_pairs(odd.where("doc_id = 2")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0  # its own next
    assert fingerprints.fingerprints(odd).count() == odd.count()


# -- token counts and files --------------------------------------------------------------------


def _ids(text: str, path: str = BPE) -> list[int]:
    return tokens.load(path).encode(text, add_special_tokens=False).ids


def test_counts_match_the_library(docs, odd, empty):
    for path in (BPE, WORD_BPE):
        got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs, path, chunk=700, overlap=64).collect()}
        assert got == {d: (len((t or "").encode()), len(_ids(t or "", path))) for d, t in pairs(docs)}
    assert token_counts.token_counts(odd, BPE).count() == odd.count()
    assert token_counts.token_counts(empty, BPE).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab e\n\t .,'1é漢\u0085 ​<|>"), max_size=300), st.integers(80, 200))
def test_spliced_chunks_are_the_whole(text, chunk):
    parts = tokens.spliced(text, tokens.load(BPE), chunk, 20, margin=16)
    assert [i for p in parts for i in p] == _ids(text)


def test_splicing_widens_where_nothing_aligns():
    widths = []
    text = "word " * 100 + "x" * 3000 + " " * 900 + "<|endoftext|>" * 40 + " end" * 200
    got = [i for p in tokens.spliced(text, tokens.load(BPE), 256, 32, 16, lambda _, w: widths.append(w)) for i in p]
    assert got == _ids(text) and max(widths) > 32


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab  e\n\t .,'1é<|²¼ºſK"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_units_are_the_library(text):
    assert np.frombuffer(tokens.units(BPE).ids(text), "<u2").tolist() == _ids(text)


_PARTS = ["a", "é", "ɏ", "ɐ", "×", " ", "  ", "\n", "\t", ".", "'", "'s", "'ll", "t", "7", "漢", "<|endoftext|>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_PARTS), max_size=9).map("".join), max_size=9), st.sampled_from([8, 1 << 20]))
def test_texts_of_a_batch_are_cut_together(texts, together):
    own, before = tokens.units(BPE), tokens.TOGETHER
    tokens.TOGETHER = together
    try:
        got = own.many(pa.array(["skipped", *texts], pa.string())[1:])
    finally:
        tokens.TOGETHER = before
    assert [np.frombuffer(raw, "<u2").tolist() for raw in got] == [_ids(t) for t in texts]


def test_each_different_piece_of_a_batch_is_looked_up_once(monkeypatch):
    own, asked = tokens.Units(BPE), []
    monkeypatch.setattr(own, "_piece", lambda p, real=own._piece: asked.append(p) or real(p))
    own.pieces = tokens.Memory(own._piece, 1)  # remembers nothing but the last piece
    texts = ["one two, one's two,\none two", "one two"] * 50
    assert [np.frombuffer(raw, "<u2").tolist() for raw in own.many(pa.array(texts))] == [_ids(t) for t in texts]
    assert sorted(asked) == sorted({b"one", b" two", b",", b" one", b"'s", b"\n"})


def test_long_texts_go_in_parts(monkeypatch):
    text = prose(1, 3000) + "  x\n y " + "z" * 500 + " end"
    whole = _ids(text)
    monkeypatch.setattr(tokens, "LONG", 64)
    assert np.frombuffer(tokens.units(BPE).ids(text), "<u2").tolist() == whole
    monkeypatch.setattr(language, "PART_CHARS", 100)
    model = language.Model(["a", "b"], [[prose(5, 200).encode()], [b"zz yy xx ww " * 50]])
    assert language.classify(text, model.compressors(), model.languages)[0] == "a"
    assert language.classify("1" * 500, model.compressors(), model.languages)[0] == "und"


def test_unit_memory_turns_over():
    own = tokens.Units(BPE)
    own.units.size = own.pieces.size = 5
    for seed in range(20):
        text = prose(seed, 60)
        assert np.frombuffer(own.ids(text), "<u2").tolist() == _ids(text)


def test_token_files_round_trip(spark, docs):
    folder = work_folder(spark, "test-tokens")
    token_files.write_token_files(docs, folder, BPE, shard_bytes=2000)
    got = sorted(tuple(r) for r in token_files.read_token_files(spark, folder).collect())
    assert got == brute.token_files(pairs(docs), BPE)
    shards = spark.read.parquet(f"{folder}/shards").orderBy("bucket", "seq").collect()
    assert len(shards) > 2 and sum(s.n_docs for s in shards) == len(got)
    assert [s.first_doc for s in shards] == sorted(s.first_doc for s in shards)
    sha, raw = token_files.read_dictionary(spark, folder)
    assert {s.dict_sha256 for s in shards} == {sha} and hashlib.sha256(raw).hexdigest() == sha
    texts = dict(pairs(docs))
    for d in (0, 1, 6, 14):
        assert token_files.read_document(spark, folder, d) == [*_ids(texts[d] or ""), 2]
    with pytest.raises(KeyError):
        token_files.read_document(spark, folder, 999)
    with pytest.raises(ValueError):
        list(token_files.shard_ids(shards[0].asDict(), ("other", raw)))


def test_token_files_without_rows_or_with_odd_ids(spark, odd, empty):
    for df, path in ((empty, BPE), (odd, BPE), (odd, WORD_BPE)):
        folder = work_folder(spark, "test-tokens")
        token_files.write_token_files(df, folder, path)
        rows = token_files.read_token_files(spark, folder).collect()
        assert len(rows) == df.count()
        starts, at = sorted((r.start, r.n_tokens) for r in rows), 0
        for start, n in starts:
            assert start == at
            at += n
        if rows:
            assert {r.doc_id for r in rows if r.start < 5} <= {None}  # null ids come first


# -- language ----------------------------------------------------------------------------------


def _tongue(seed: int, lang: str, n: int) -> str:
    r = random.Random(f"{lang}{seed}")
    parts = {"aa": ["tha", "ing", "ous", "the", "and"], "bb": ["eux", "oir", "les", "que", "ère"], "cc": ["ung", "sch", "und", "ein", "ätz"]}
    return " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def tongues(spark):
    own = [(i, _tongue(i, ("aa", "bb", "cc")[i % 3], 5 + i % 60), ("aa", "bb", "cc")[i % 3]) for i in range(300)]
    return spark.createDataFrame(own, "doc_id long, text string, lang string")


def test_held_out_languages_are_told(tongues):
    model = language.train(tongues.where(~language.held_out_column()))
    assert sorted(model.languages) == ["aa", "bb", "cc"]
    got = language.identify(tongues, model).join(tongues.select("doc_id", "lang"), "doc_id").collect()
    own = [r for r in got if language.held_out(r.doc_id)]
    assert len(own) > 40 and np.mean([r.lang == r.lang_pred for r in own]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    loud = language.identify(tongues.selectExpr("doc_id", "upper(text) || '!!' text"), model).collect()
    assert {r.doc_id: r.lang_pred for r in loud} == {r.doc_id: r.lang_pred for r in got}


def test_language_of_awkward_texts(spark, docs, tongues, empty):
    model = language.train(tongues)
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert {got[k].lang_pred for k in (0, 1, 16)} == {"und"} and got[0].score == 0 and got[1].rejected
    assert all(got[k].lang_pred in model.languages for k in (2, 6, 12, 13))
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if not r.rejected}
    assert language.identify(empty, model).count() == 0
    none = language.train(empty)
    assert none.languages == [] and {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    one = language.train(tongues.where("lang = 'aa'"))
    assert language.classify("x y", one.compressors(), one.languages) == ("aa", 1.0, False)


def test_scores_do_not_depend_on_the_parts(monkeypatch):
    model = language.Model(["a", "b"], [[prose(5, 200).encode()], [b"zz yy xx ww " * 50]])
    made = model.compressors()
    texts = [
        "kanlo mist " * 4000, "kanlo, " * 9000, prose(6, 5000), "1 2 " * 900 + "kan lo", "ab" * 9000, "x " + "é" * 700 + "1" * 300 + "kan",
        "ΟΔΟΣ ΑΣ' Σ " * 400, "İI " * 700, "7" * 999, "zz" + "\n" * 500 + "yy " * 200, "kan\x1c" * 99,
    ]
    whole = [language.classify(t, made, model.languages) for t in texts]
    raws = [language.letters(t) for t in texts]
    for size in (1 << 18, 1000, 100, 7):
        monkeypatch.setattr(language, "PART_CHARS", size)
        assert [b"".join(language.word_blocks(t)) for t in texts] == raws
        assert [language.classify(t, made, model.languages) for t in texts] == whole
    assert all(len(b) == language.BLOCK_BYTES for b in list(language.word_blocks(texts[0]))[:-1])


# -- secrets -----------------------------------------------------------------------------------


def test_secrets_match_plain_search(spark, docs, odd, empty):
    ledger = f"{work_folder(spark, 'test-ledger')}/l"
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.spans) for r in secrets.findings(docs, ledger).collect()}
    assert got == {d: (lambda b: (*b[:3], b[4]))(brute.secrets(t)) for d, t in pairs(docs)}
    assert got[14][:3] == (2, 1, 1)
    assert secrets.findings(odd, ledger, keep=["doc_id", "source"]).count() == odd.count()
    assert secrets.findings(empty, f"{work_folder(spark, 'test-ledger')}/l").count() == 0


def test_only_unseen_blobs_are_scanned(spark, monkeypatch):
    ledger = f"{work_folder(spark, 'test-ledger')}/l"
    first = spark.createDataFrame([("a", 1, "token=abcdef1"), ("b", 1, "token=abcdef1"), ("c", 1, "plain")], "path string, version int, text string")
    second = first.unionAll(spark.createDataFrame([("a", 2, "token=zzzzzz9"), ("d", 1, "plain")], first.schema))
    assert secrets.findings(first, ledger, keep=["path", "version"]).where("n_assign = 1").count() == 2
    assert secrets.read_ledger(spark, ledger).count() == 2
    assert secrets.findings(second, ledger, keep=["path", "version"]).count() == 5
    assert secrets.read_ledger(spark, ledger).count() == 3  # one new blob, though two new versions
    monkeypatch.setattr(secrets, "rule_version", lambda rules=(): "next")
    assert secrets.findings(first, ledger, keep=["path", "version"]).count() == 3
    assert secrets.read_ledger(spark, ledger).groupBy("rule_version").count().count() == 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "Token", "api_key", "secret", "=", ":", " ", '"', "'", "abc", "AKIA", "ABCDEFGH", "0123456789abcdef", "f", "\n", "ſecret"]), max_size=14))
def test_secret_spans(parts):
    text = "".join(parts)
    assert ",".join(f"{k}:{a}:{b}" for a, _, k, b in secrets.find_spans(text)) == brute.secrets(text)[4]


# -- decontamination ---------------------------------------------------------------------------


def _distance(p: str, t: str) -> int:
    """Least edit distance of ``p`` to a part of ``t``, by the usual table."""
    row = list(range(len(p) + 1))
    best = row[-1]
    for ch in t:
        last, row[0] = row[0], 0
        for i, c in enumerate(p, 1):
            last, row[i] = row[i], min(last + (c != ch), row[i] + 1, row[i - 1] + 1)
        best = min(best, row[-1])
    return best


def test_myers_is_the_usual_distance():
    r = random.Random(5)
    for _ in range(200):
        p, t = ("".join(r.choice("abc ") for _ in range(r.randint(1, 70))) for _ in range(2))
        assert min([len(p), *decontaminate.myers(decontaminate._bits(p), len(p), t)]) == _distance(p, t)


def test_leaks_match_the_edit_distance(spark):
    r = random.Random(1)
    items = [(k, prose(100 + k, 20)) for k in range(8)] + [(8, "too short"), (9, None), (10, "")]
    own = []
    for d in range(60):
        k, body = r.randrange(8), prose(500 + d, 60)
        passage = list(items[k][1])
        for _ in range(r.randint(0, 8)):
            i = r.randrange(len(passage))
            passage[i : i + 1] = r.choice([[], ["q"], [passage[i], "z"]])
        shown = "".join(passage)
        own.append((d, f"{body} {shown.upper() if d % 3 else shown}, {body[:50]}" if d % 4 else body))
    own += [(60, "Too  short!"), (61, None), (62, ""), (63, "it is too short for that")]
    docs = spark.createDataFrame(own, "doc_id long, text string")
    bench = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    hits = decontaminate.leaks(docs, bench).collect()
    got = {(h.doc_id, h.item_id): h for h in hits}
    plain = decontaminate.plain
    want = {
        (d, k) for d, t in own for k, p in items[:8]
        if _distance(plain(p), plain(t or "")) <= int(decontaminate.ERROR_RATE * len(plain(p)))
    }
    assert set(got) == want | {(60, 8), (63, 8)} and len(want) > 20
    # with a floor, an item of fewer bytes matches only a text that is nothing else
    assert {(h.doc_id, h.item_id) for h in decontaminate.leaks(docs, bench, min_bytes=10).collect()} == want | {(60, 8)}
    texts, benchmark = dict(own), dict(items)
    for (d, k), h in got.items():
        assert h.distance == _distance(plain(benchmark[k]), plain(texts[d]))
        assert _distance(plain(texts[d][h.start : h.end]), plain(benchmark[k])) <= h.distance + 20
    left = decontaminate.without_leaks(docs, bench)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in own} - {d for d, _ in got}


def test_short_items_and_scripts_without_spaces_leak(spark):
    r = random.Random(2)
    han, other, kana = ("".join(chr(a + r.randrange(n)) for _ in range(m)) for a, n, m in ((0x4E00, 5000, 300), (0x4E00, 5000, 90), (0x3041, 80, 60)))
    thai = "กรงเทพมหานครเมองหลวง"
    items = [(0, han), (1, "Who wrote Hamlet?"), (2, "the art of"), (3, han[40:47]), (4, thai), (5, kana), (6, "hi"), (7, "art"), (8, "漢字")]
    own = [
        (0, f"{other}{han}{other}"), (1, f"{other}{han[:150]}{other[:5]}{han[151:]}"), (2, "Asked who wrote Hamlet, he left."), (3, "bathe art often"),
        (4, f"{other}{han[40:47]}{other}"), (5, "กก" + thai + "นน"), (6, f"x {kana} y"), (7, "Hi!"), (8, "say hi, art"), (9, "on the Art, of war"), (10, "漢字漢字"),
    ]
    docs, bench = spark.createDataFrame(own, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    hits = {(h.doc_id, h.item_id): h for h in decontaminate.leaks(docs, bench).collect()}
    longer = {(0, 0), (0, 3), (1, 0), (1, 3), (2, 1), (4, 3), (5, 4), (6, 5), (7, 6), (9, 2)}
    assert set(hits) == longer | {(3, 7), (8, 6), (8, 7), (9, 7), (10, 8)}
    assert {(h.doc_id, h.item_id) for h in decontaminate.leaks(docs, bench, min_bytes=10).collect()} == longer
    assert own[2][1][hits[2, 1].start : hits[2, 1].end] == "who wrote Hamlet" and hits[1, 0].distance == 5
    assert {x.doc_id for x in decontaminate.without_leaks(docs, bench, min_bytes=10).collect()} == {3, 8, 10}
    assert decontaminate.without_leaks(docs, bench).count() == 0


def test_separate_spans_are_the_nearest():
    r = random.Random(3)
    for _ in range(300):
        spans = [(r.randrange(2), a, a + r.randint(1, 9), r.randrange(3)) for a in (r.randrange(60) for _ in range(r.randint(0, 25)))]
        kept: list = []
        for s in sorted(spans, key=lambda s: (s[0], s[3], s[1])):
            if not any(s[0] == t[0] and s[1] < t[2] and t[1] < s[2] for t in kept):
                kept.append(s)
        assert decontaminate._separate(spans) == sorted(kept, key=lambda s: (s[0], s[1]))


def test_leaks_in_blocks_and_without_rows(docs, empty, spark, monkeypatch):
    bench = spark.createDataFrame([(k, prose(3, 400)[k * 40 : k * 40 + 150]) for k in range(9)], "item_id long, text string")
    whole = sorted(tuple(r) for r in decontaminate.leaks(docs, bench).collect())
    assert {r[0] for r in whole} >= {10, 11}
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 4)
    blocks = [b for b in decontaminate.blocks_of(bench, 4)]
    assert [len(b) for b in blocks] == [4, 4, 1]
    assert decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == docs.count()


# -- cases that once went wrong -----------------------------------------------------------------


def test_fingerprints_of_two_sizes_in_one_process():
    text = prose(1, 30)
    for bins in (9, 10, 8, 9):
        assert len(fingerprints.sketch(fingerprints.shingle_pieces(text), bins)) == 1 << bins


def test_documents_beside_null_ids_and_repeated_ids_are_read(spark):
    own = [(None, "first"), (1, "one two"), (1, "another"), (2, "three")]
    folder = f"{work_folder(spark, 'test-ids')}/t"
    token_files.write_token_files(spark.createDataFrame(own, "doc_id long, text string").coalesce(1), folder, BPE)
    assert token_files.read_document(spark, folder, 2) == [*_ids("three"), 2]
    assert sorted(token_files.read_documents(spark, folder, 1)) == sorted([*_ids(t), 2] for t in ("one two", "another"))
    assert token_files.read_documents(spark, folder, 7) == []


def test_a_ledger_written_by_two_runs_at_a_time_counts_once(spark):
    own = spark.createDataFrame([(1, "password=hunter22", "p")], "doc_id long, text string, blob string")
    ledger = f"{work_folder(spark, 'test-ledger')}/l"
    secrets.scan_new_blobs(own, ledger)
    secrets.read_ledger(spark, ledger).coalesce(1).write.mode("append").parquet(ledger)  # the other run's commit
    got = secrets.findings(own, ledger, keep=["doc_id", "blob"]).collect()
    assert [(r.doc_id, r.own_blob, r.n_assign) for r in got] == [(1, "p", 1)]
    rules = (("hex", r"[0-9a-f]+", 0, 2), *secrets.RULES[:2])
    assert secrets.rule_version(rules) != secrets.rule_version()
    assert [r.n_hex for r in secrets.findings(own, ledger, rules=rules).collect()] == [1]


def test_words_are_letters_with_their_marks():
    assert language.letters("½ ² Ⅷ ①② 12 _") == b""
    assert language.letters("नमस्ते Ünï ½x e\u0301a 3½").decode() == "नमस्ते ünï x e\u0301a"
    for text in ("नमस्ते" * 30, "½" * 50 + "ab" * 50, "e\u0301" * 90):
        for chars in (7, 16, 1000):
            old, language.PART_CHARS = language.PART_CHARS, chars
            try:
                assert b"".join(language.word_blocks(text)) == language.letters(text), (text[:9], chars)
            finally:
                language.PART_CHARS = old


def test_short_items_are_found_at_word_borders():
    matcher = decontaminate.Matcher([(1, "art of"), (2, "漢字"), (3, "2+2=4"), (4, "who am i"), (5, "?!")], decontaminate.ERROR_RATE)
    text = "The ART of 漢字, 2+2=4! Who am I? start off"
    assert sorted(h[0] for h in matcher.find(text)) == [1, 2, 3, 4]
    assert matcher.find("start off, 12+2=45") == []
    assert decontaminate.Matcher([(1, "art of")], decontaminate.ERROR_RATE, 10).find(text) == []
