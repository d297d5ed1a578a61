"""Operators over whole tables against plain forms: mixing, chats, near-duplicates, repeats, components; the pipeline."""

import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from workdays.llm import chat, exact_dedup, graph, hashing, mixing, near_dedup, registry, tokens
from workdays.llm.common import work_folder
from workdays.llm.suffix_array import repeated_starts, suffix_array

from . import brute
from .conftest import pairs, prose

BPE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


# -- mixing ------------------------------------------------------------------------------------


def _targets(sizes: dict, weights=(1, 2, 3), cap=3) -> dict:
    """Shares by weight; what is above the cap is dealt again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full: set = set()
    while True:
        rest = sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        level = rest / max(1, sum(w[s] for s in names if s not in full))
        over = {s for s in names if s not in full and level * w[s] > cap * sizes[s] + 1e-9}
        if not over:
            return {s: cap * sizes[s] if s in full else level * w[s] for s in names}
        full |= over


def _mixed(df) -> list:
    return mixing.systematic_copies(df).collect()


def test_mix_meets_its_targets(spark):
    r = random.Random(2)
    own = [(i, f"s{min(int(r.expovariate(0.7)), 6)}" if i % 50 else None, "w " * r.randint(0, 80)) for i in range(3000)]
    docs = spark.createDataFrame(own, "doc_id long, source string, text string").repartition(7)
    got = _mixed(docs)
    sizes: Counter = Counter()
    for _, s, t in own:
        sizes[s] += len(t.split())
    want = _targets(sizes)
    for s in sizes:
        rows = [x for x in got if x.source == s]
        assert rows[0].target == pytest.approx(want[s]) and rows[0].source_size == sizes[s]
        assert abs(sum(x.copies * x.size for x in rows) - want[s]) <= 80
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert all(0 <= x.copies <= 3 for x in got)
    again = {x.doc_id: x.copies for x in _mixed(docs.repartition(3))}
    assert again == {x.doc_id: x.copies for x in got}
    mixed = Counter(x.doc_id for x in mixing.mix(docs).collect())
    assert mixed == {k: n for k, n in again.items() if n}


def test_mix_of_awkward_rows(docs, odd, empty):
    assert len(_mixed(docs)) == docs.count()
    assert mixing.mix(docs).columns == docs.columns
    assert len(_mixed(odd)) == odd.count()
    assert mixing.mix(odd).count() == sum(x.copies for x in _mixed(odd))
    assert _mixed(empty) == [] and mixing.mix(empty).count() == 0
    none = docs.where("doc_id < 2")
    assert [x.copies for x in _mixed(none)] == [0, 0]  # no words at all


# -- chat packs --------------------------------------------------------------------------------


CHATS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hello"), (1, 2, "assistant", "hi"),
    (2, 0, "system", "be brief"), (2, 1, "user", "hello"), (2, 2, "assistant", "good day"), (2, 3, "user", "bye"),
    (3, 0, "system", "be brief"), (3, 1, "user", "hello"), (3, 2, "assistant", "hi"),
    (4, 0, "user", None), (4, 1, "assistant", ""), (4, None, None, "no turn"), (4, 1, "assistant", ""),
    (5, 0, "a\nb\\n", "<|im_end|>\n<|im_start|>assistant\n<\\|x <|<| |>"), (5, 1, "assistant", "<|endoftext|> 漢 <\\\\|"),
    (None, 0, "user", "whose?"), (7, 0, "assistant", "é" * 50),
]


@pytest.fixture(scope="module")
def chats(spark):
    own = [(*r, "x", 1) for r in CHATS]
    return spark.createDataFrame(own, "conv_id long, turn long, role string, text string, key string, leaf int").repartition(3)


def test_chats_read_back(spark, chats):
    ordered = [(c, -1 if t is None else t, r, x) for c, t, r, x in CHATS]
    want = brute.chats(ordered)
    for size in (1, 60, 100_000):
        packs = chat.format_conversations(chats, BPE, pack_tokens=size)
        got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(packs, BPE).collect()}
        assert got == want


def test_shared_turns_are_emitted_once(spark, chats):
    packs = chat.format_conversations(chats.where("conv_id < 4").coalesce(1), BPE).collect()
    assert sum(len(p.segments) for p in packs) <= 5 * len(packs)
    for p in packs:
        for s in p.segments:
            seen, k = [], s.parent
            while k >= 0:
                seen.append((p.segments[k].start, p.segments[k].end))
                k = p.segments[k].parent
            allowed = sorted(i for a, b in seen for i in range(a, b))
            assert allowed == sorted(i for x in s.attends for i in range(x.start, x.end))
            assert s.position == len(allowed) and all(x.end <= s.start for x in s.attends)
            assert p.position_ids[s.start : s.end] == list(range(s.position, s.position + s.end - s.start))
        assert len(p.input_ids) == len(p.position_ids) == p.segments[-1].end


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("<|\\>n\nab im_start"), max_size=40))
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_no_chats(chats):
    assert chat.format_conversations(chats.limit(0), BPE).count() == 0


# -- near-duplicates ---------------------------------------------------------------------------


def _near(df, k: int, pct: int) -> dict:
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, k, pct).collect()}


def test_near_duplicates_of_awkward_rows(docs, odd, empty):
    for k, pct in ((3, 85), (5, 80)):
        assert _near(docs, k, pct) == brute.near_duplicates(pairs(docs), k, pct)
    rows = near_dedup.near_duplicates(odd, 3, 85).collect()
    assert len(rows) == odd.count() and all(r.kept for r in rows if r.doc_id is None)
    assert {r.component_id for r in rows if r.doc_id == 2} == {1}
    assert near_dedup.near_duplicates(empty).count() == 0
    left = near_dedup.one_of_each(odd)
    assert left.columns == odd.columns and Counter(r.doc_id for r in left.collect()) == {1: 2, 3: 2, None: 2}


def test_removal_goes_by_id_and_text(spark):
    a, b = prose(60, 80), prose(61, 80)
    own = [(1, a, "x"), (2, a, "y"), (2, b, "z"), (2, b, "z"), (2, b, "a"), (None, a, "n"), (4, None, "e"), (5, "", "f")]
    docs = spark.createDataFrame(own, "doc_id long, text string, lang string")
    for parts in (1, 3):
        left = near_dedup.one_of_each(docs.repartition(parts)).collect()
        got = sorted((tuple(r) for r in left), key=str)
        assert [x[:2] for x in got] == sorted([(1, a), (2, b), (None, a), (4, None), (5, "")], key=lambda x: str((*x, "")))
        assert next(x for x in got if x[0] == 2)[2] in ("z", "a")
    assert near_dedup.one_of_each(docs).where("doc_id = 2").collect() == near_dedup.one_of_each(docs.repartition(4)).where("doc_id = 2").collect()


def test_texts_without_words_pass_by_the_join(spark):
    empty = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN NULL ELSE concat('w', id, ' x y') END AS text")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = [len(p) for p in near_dedup.near_duplicates(empty.repartition(8)).select("doc_id").rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for k in keys:
            spark.conf.unset(k)
    assert sum(sizes) == 4000 and max(sizes) <= 700


def test_near_duplicates_at_the_threshold_are_found(spark):
    r, own = random.Random(9), []
    for n in (8, 20, 60, 200):
        for _ in range(40):
            # one word of a text is changed: of s shingles, s - 3 are shared, so the set must be long enough
            words = [f"v{r.randrange(10 ** 9)}" for _ in range(n + 2)]
            tail = [f"v{r.randrange(10 ** 9)}"]
            cut = int(0.15 * n / 1.85)  # shared n - cut of n + cut: just at 85 in 100 or above
            own += [(len(own), " ".join(words)), (len(own) + 1, " ".join(words[cut:] + tail * (cut > 0) + [f"u{r.randrange(10 ** 9)}" for _ in range(cut - 1)]))]
    docs = spark.createDataFrame(own, "doc_id long, text string").repartition(4)
    assert _near(docs, 3, 85) == brute.near_duplicates(own, 3, 85)


def test_a_large_group_of_near_copies_is_split(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    r = random.Random(4)
    base = [prose(50, 90).split(), prose(51, 90).split()]
    own = []
    for i in range(160):
        words = list(base[i % 2])
        for _ in range(r.randint(0, 4)):
            words[r.randrange(len(words))] = f"w{r.randrange(10 ** 6)}"
        own.append((i, " ".join(words)))
    docs = spark.createDataFrame(own, "doc_id long, text string").repartition(4)
    assert _near(docs, 3, 85) == brute.near_duplicates(own, 3, 85)


def test_block_links_are_exact():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 30, size=r.integers(1, 25)).astype(np.uint64)) for _ in range(40)]
    want = {
        (i, j) for i in range(40) for j in range(i + 1, 40)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j]))
    }
    assert set(near_dedup.block_links(sets, None, 60)) == want
    cross = set(near_dedup.block_links(sets[:15], sets[15:], 60))
    assert {(i, j + 15) for i, j in cross} == {(i, j) for i, j in want if i < 15 <= j}
    ids, again = near_dedup.unpack_block(near_dedup.pack_block(list(range(40)), sets))
    assert ids == list(range(40)) and all((a == b).all() for a, b in zip(again, sets, strict=True))


def test_words_hash_alike_in_pieces():
    raw = ("A  b\tC\n" * 50 + "déjà x" * 20).encode()
    assert (hashing.word_hashes(raw) == hashing.word_hashes(raw, piece=7)).all()
    assert (hashing.word_shingles(b"ABC def G", 3) == hashing.word_shingles(b"abc  def\tg", 3)).all()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    parent = list(range(26))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in graph.components(df).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


# -- repeated strings --------------------------------------------------------------------------


def test_suffix_array_is_sorted():
    r = random.Random(1)
    for _ in range(300):
        t = [r.randint(1, r.choice([1, 2, 3, 6])) for _ in range(r.randint(0, 70))]
        assert suffix_array(np.array(t, dtype=np.int64), 258).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("length", [3, 8, 11])
def test_repeated_starts(length):
    r = random.Random(length)
    for _ in range(60):
        strings = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 40))) for _ in range(4)]
        symbols, valid, where, at = [], [], {}, 0
        for x in strings:
            symbols += [c + 2 for c in x] + [1]
            valid += [i + length <= len(x) for i in range(len(x))] + [False]
            for i in range(len(x) - length + 1):
                where.setdefault(x[i : i + length], []).append(at + i)
            at += len(x) + 1
        want = sorted(i for v in where.values() if len(v) > 1 for i in v)
        assert np.flatnonzero(repeated_starts(np.array(symbols, dtype=np.uint16), np.array(valid), length)).tolist() == want


def _repeats(df, length: int) -> list:
    return sorted(tuple(r) for r in exact_dedup.without_repeats(df, length, keep_text=False).drop("kept").na.fill({"doc_id": -1}).collect())


def _want(df, length: int) -> list:
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in brute.repeats(pairs(df), length))


def test_repeats_of_awkward_rows(docs, odd, empty, monkeypatch):
    assert _repeats(docs, 200) == _want(docs, 200)
    assert _repeats(odd, 200) == _want(odd, 200)
    assert exact_dedup.without_repeats(empty).count() == 0
    kept = {r.doc_id: r.kept for r in exact_dedup.without_repeats(docs).collect()}
    assert bytes(kept[20]).decode() == dict(pairs(docs))[20] and bytes(kept[12]) == b""
    for name, value in (("HOT", 1), ("SHARD_BYTES", 500), ("_PIECE", 3000), ("HELD_REGIONS", 40)):
        monkeypatch.setattr(exact_dedup, name, value)
    assert _repeats(docs, 200) == _want(docs, 200)


def test_repeats_around_shared_passages(spark):
    r = random.Random(3)
    shared = [prose(200 + k, 60) for k in range(4)]
    own = []
    for d in range(80):
        parts = [prose(1000 + d, r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randint(0, len(s) // 2)
            parts += [s[a : a + r.randint(150, 330)], prose(5000 + r.randrange(9999), r.randint(0, 9))]
        own.append((d, "".join(parts)))
    docs = spark.createDataFrame(own, "doc_id long, text string").repartition(6)
    assert _repeats(docs, 200) == _want(docs, 200)


# -- registered queries and the pipeline -------------------------------------------------------


def test_every_query_has_its_table_and_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = registry.QUERIES["op2_mixing"](spark, SF).toPandas()
    want = con.sql(registry.ORACLE["op2_mixing"]).df()[list(got.columns)]
    order = ["doc_id"]
    a, b = (x.sort_values(order).reset_index(drop=True) for x in (got, want))
    assert (a.astype(str) == b.astype(str)).all().all()
    assert {k.split("_")[0] for k in registry.QUERIES} == {f"op{n}" for n in range(1, 11)} | {"pipeline"}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_dedup", "decontamination", "mixing", "token_files"]
    own, sizes = docs, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = own
        own = stage(spark, own, SF)
        path = work_folder(spark, "test-pipeline")
        own.write.parquet(path)
        own = spark.read.parquet(path)
        sizes.append(own.count())
        if k < 4:
            assert own.columns == docs.columns
        if k == 1:
            rows = {r.doc_id: r.text for r in before.collect()}
            want = brute.near_duplicates(list(rows.items()), 5, 80)
            assert {r.doc_id for r in own.collect()} == {d for d, (_, c) in want.items() if c == d}
        if k == 3:
            mixed = sorted((r.doc_id, r.text) for r in own.collect())
    assert sizes[0] > 0.9 * docs.count() and sizes[3] == sizes[4]
    whole = [len(tokens.load(BPE).encode(t, add_special_tokens=False).ids) + 1 for _, t in mixed]
    assert sorted(r.n_tokens for r in own.collect()) == sorted(whole)
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, SF).count() == sizes[4]
