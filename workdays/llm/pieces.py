"""SentencePiece byte-pair encoding and decoding without merge queues.

The encoding of a text ends in one token only, and so does the encoding of each of its
prefixes; what stands before that token is the encoding of the shorter prefix. So a table with
the last token of every prefix is the whole encoding. It is filled from left to right: an
automaton over the vocabulary gives the tokens that end at a place, and the one that the merges
leave beside the last token of the prefix before it is the entry. The ids are read backwards.

Two tokens stay apart if merging their joined characters gives the two again. Merging goes by
rank, so it is enough to walk down the right edge of the left token's merge tree and the left
edge of the right one's in the order of their merges, and to see whether a piece over the border
would have come first. Answers are remembered.

Pieces of blanks alone share one rank, below all others; they grow from the left, after the words,
so a run of blanks has its own rule. No piece has a blank behind another character, so texts are
cut at blanks (and at characters of no piece) and the ids of short units are remembered.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, columns_of, text_or_empty
from .tokens import Memory

BLANK = "▁"
# Short units are remembered in two generations of so many.
REMEMBERED = 250_000
# Up to this length a table is a list, which is faster; longer ones take four bytes a character.
LISTED = 64
PAIRS = 400_000
# Signs that often follow a word: word and signs are looked up apart.
SIGNS = ".,;:!?)&#"
# Code points of a text that are cut into units at a time.
LONG = 1 << 18
_NEVER = 1 << 60

_loaded: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """The model of a file, once per process."""
    if path not in _loaded:
        _loaded[path] = PieceModel(path)
    return _loaded[path]


class PieceModel:
    """Encoder and decoder for one SentencePiece file.

    The file must hold a BPE model with byte fallback, the identity normalizer with a dummy
    prefix, and no user-defined or unused pieces; otherwise ValueError.
    """

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb2

        proto = pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec, kind = proto.normalizer_spec, pb2.ModelProto.SentencePiece
        kinds = [p.type for p in proto.pieces]
        if (
            proto.trainer_spec.model_type != pb2.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback
            or spec.name != "identity" or not spec.add_dummy_prefix or spec.remove_extra_whitespaces
            or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix
            or kind.USER_DEFINED in kinds or kind.UNUSED in kinds or kinds.count(kind.BYTE) != 256 or len(kinds) >= 1 << 16
        ):
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no normalization")
        self.pieces = [p.piece for p in proto.pieces]
        normal = [i for i, k in enumerate(kinds) if k == kind.NORMAL]
        self.ids = {self.pieces[i]: i for i in normal}
        if any(BLANK in p.lstrip(BLANK) or p.startswith(BLANK * 2) and p.strip(BLANK) for p in self.ids):
            raise ValueError("a piece holds a blank behind another character")
        words = [i for i in normal if self.pieces[i].strip(BLANK)]
        scores = [proto.pieces[i].score for i in words]
        runs = sorted(len(p) for p in self.ids if not p.strip(BLANK))
        run_scores = {proto.pieces[self.ids[BLANK * n]].score for n in runs if n > 1}
        if len(set(scores)) != len(scores) or len(run_scores) > 1 or run_scores and max(run_scores) >= min(scores):
            raise ValueError("scores are not an order of merges")
        # Rank of each piece that can come from a merge; smaller merges first.
        self.rank = {self.pieces[i]: k for k, i in enumerate(sorted(words, key=lambda i: -proto.pieces[i].score)) if len(self.pieces[i]) > 1}
        self.byte = [0] * 256
        for i, k in enumerate(kinds):
            if k == kind.BYTE:
                self.byte[int(self.pieces[i][1:-1], 16)] = i  # <0x41>
        self.length = [len(p) for p in self.pieces]
        self.runs = set(runs)
        self.longest_run = max(runs, default=1)
        known = {c for p in self.ids for c in p}
        self.apart = "\n" not in known
        self.automaton = ahocorasick.Automaton()
        for i in words:
            self.automaton.add_word(self.pieces[i], i)
        if BLANK in self.ids:
            self.automaton.add_word(BLANK, self.ids[BLANK])
        self.automaton.make_automaton()
        self.edges: dict[int, tuple | None] = {}
        self.apart_pairs: dict[int, bool] = {}
        self.after_blank = Memory(self._after_blank, REMEMBERED)
        self.bare = Memory(self._unit, REMEMBERED // 4)
        self._newline = self._raw([self.byte[10]]) if self.apart else b""
        self._decode_tables(kinds, kind, proto.trainer_spec.unk_surface)

    # -- the merges of one string ---------------------------------------------------------

    def _merged(self, text: str) -> tuple[list[str], list[tuple]]:
        """(symbols, merges made in order as (rank, left, right)) of a short string, by plain merging."""
        parts, made = list(text), []
        while True:
            best, at = _NEVER, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1], _NEVER)
                if r < best:
                    best, at = r, i
            if at < 0:
                return parts, made
            made.append((best, parts[at], parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _edges(self, token: int) -> tuple | None:
        """(merges go by rank, left edge, right edge) of a token's merge tree.

        An edge lists (symbol, rank of the merge that makes it), the single character first.
        None: merging the token's characters gives something else, so no text has this token.
        """
        if token not in self.edges:
            piece = self.pieces[token]
            parts, made = self._merged(piece)
            if len(parts) != 1:
                self.edges[token] = None
            else:
                first, last = [(piece[0], -1)], [(piece[-1], -1)]
                for r, a, b in _spans(piece, made):
                    if a == 0:
                        first.append((piece[a:b], r))
                    if b == len(piece):
                        last.append((piece[a:b], r))
                ordered = all(x[0] < y[0] for x, y in zip(made, made[1:], strict=False))
                self.edges[token] = (ordered, first, last)
        return self.edges[token]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the characters of two tokens, joined, are merged into just these two."""
        key = left << 16 | right
        found = self.apart_pairs.get(key)
        if found is None:
            if len(self.apart_pairs) >= PAIRS:
                self.apart_pairs.clear()
            found = self.apart_pairs[key] = self._stay_apart(left, right)
        return found

    def _stay_apart(self, left: int, right: int) -> bool:
        a, b = self._edges(left), self._edges(right)
        if a is None or b is None:
            return False
        if not (a[0] and b[0]):  # merges out of order: merge the joined characters
            return self._merged(self.pieces[left] + self.pieces[right])[0] == [self.pieces[left], self.pieces[right]]
        ends, starts, i, j = a[2], b[1], 0, 0
        while True:
            over = self.rank.get(ends[i][0] + starts[j][0], _NEVER)
            mine = ends[i + 1][1] if i + 1 < len(ends) else _NEVER
            theirs = starts[j + 1][1] if j + 1 < len(starts) else _NEVER
            if over < mine and over <= theirs and over < _NEVER:
                return False
            if mine == theirs == _NEVER:
                return True
            if mine <= theirs:
                i += 1
            else:
                j += 1

    # -- prefix table ---------------------------------------------------------------------

    def table(self, text: str) -> list[int] | array:
        """Last token of the prefix of each length; -1 for length 0 and where the last character is in no piece."""
        last, filled = ([-1] if len(text) <= LISTED else array("i", [-1])) * (len(text) + 1), 0
        apart, length = self.apart_pairs, self.length
        for end, token in self.automaton.iter(text):
            end += 1
            if end == filled:
                continue  # the one token that fits is found
            before = last[end - length[token]]
            if before < 0:
                fits = self._edges(token) is not None
            else:
                fits = apart.get(before << 16 | token)
                if fits is None:
                    fits = self.stay_apart(before, token)
            if fits:
                last[end] = token
                filled = end
        return last

    def _word(self, text: str) -> list[int]:
        """Ids of a string with at most one blank, its first character."""
        last, ids, end, length = self.table(text), [], len(text), self.length
        while end:
            token = last[end]
            if token < 0:
                ids += [self.byte[b] for b in reversed(text[end - 1].encode())]
                end -= 1
            else:
                ids.append(token)
                end -= length[token]
        ids.reverse()
        return ids

    def _run(self, n: int) -> list[int]:
        """Ids of ``n`` blanks: the leftmost pieces grow first, as long as there are pieces."""
        ids, rest = [], n
        while rest >= self.longest_run and self.longest_run in self.runs:
            ids.append(self.ids[BLANK * self.longest_run])
            rest -= self.longest_run
        while rest:
            size = 1
            while size < rest and size + 1 in self.runs:
                size += 1
            if rest > size and rest - size in self.runs and rest in self.runs:
                size = rest  # the rest has grown to a piece that joins this one
            ids.append(self.ids[BLANK * size])
            rest -= size
        return ids

    @staticmethod
    def _raw(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}H", *ids)

    def _unit(self, unit: str) -> bytes:
        """Ids of a string of other characters than blanks, one blank before it or none."""
        blank = unit.startswith(BLANK)
        base = unit.rstrip(SIGNS)
        if blank < len(base) < len(unit):
            # two encodings side by side are one if the tokens at the border stay apart
            left = self.after_blank[base[1:]] if blank else self.bare[base]
            right = self.bare[unit[len(base) :]]
            if self.stay_apart(left[-2] | left[-1] << 8, right[0] | right[1] << 8):
                return left + right
        return self._raw(self._word(unit))

    def _after_blank(self, word: str) -> bytes:
        """Ids of one blank and a word; of the blank alone, where the word is empty."""
        return self._unit(BLANK + word) if word else self._raw(self._run(1))

    def _spaced(self, unit: str) -> bytes:
        """Ids of a run of two or more spaces, or of a space at the end, and the word behind it."""
        word = unit.lstrip(" ")
        blanks = len(unit) - len(word)
        if not word:
            return self._raw(self._run(blanks))
        ids = self.after_blank[word] if blanks else self.bare[word]
        if blanks > 1:
            alone = ids[:2] == self._raw(self._run(1))
            ids = self._raw(self._run(blanks if alone else blanks - 1)) + ids[2 * alone :]
        return ids

    def _line(self, line: str) -> bytes:
        """Ids of text whose blanks are spaces, cut into units: words with what stands before them."""
        if "  " in line or line.endswith(" "):
            return b"".join([self._spaced(u) for u in _UNITS.findall(line)])
        head, *rest = line.split(" ")
        after_blank = self.after_blank
        ids = b"".join([after_blank[w] for w in rest])
        return self.bare[head] + ids if head else ids

    def _part(self, text: str) -> bytes:
        """Ids of a text whose blanks are spaces; a line end is a unit when no piece holds one."""
        return self._newline.join([self._line(x) for x in text.split("\n")]) if self.apart else self._line(text)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as the library's ``encode(text)``; an empty text has none."""
        if not text:
            return np.empty(0, np.uint16)
        text = " " + text.replace(BLANK, " ")
        if len(text) <= LONG:
            return np.frombuffer(self._part(text), "<u2")
        made, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + LONG)
            end = cut.start() + 1 if cut else len(text)
            made.append(self._part(text[at:end]))
            at = end
        return np.frombuffer(b"".join(made), "<u2")

    # -- decoding -------------------------------------------------------------------------

    def _decode_tables(self, kinds, kind, unknown: str) -> None:
        self.surface: list[bytes] = []
        byte_of = {i: b for b, i in enumerate(self.byte)}
        for i, k in enumerate(kinds):
            if k == kind.BYTE:
                self.surface.append(bytes([byte_of[i]]))
            elif k == kind.CONTROL:
                self.surface.append(b"\xff")  # no UTF-8: ids with one are decoded run by run
            elif k == kind.UNKNOWN:
                self.surface.append(unknown.encode())
            else:
                self.surface.append(self.pieces[i].replace(BLANK, " ").encode())
        self.is_byte = {i for i, k in enumerate(kinds) if k == kind.BYTE}
        self.silent = {i for i, k in enumerate(kinds) if k == kind.CONTROL}
        self.strips = {i for i, k in enumerate(kinds) if k == kind.NORMAL and self.pieces[i].startswith(BLANK)}

    def decode(self, ids: list[int]) -> str:
        """Text of ids, as the library's ``decode(ids)``.

        Control ids say nothing; the dummy blank goes; bytes that are no character give one
        replacement character each. An id outside the vocabulary raises IndexError.
        """
        first = next((k for k, i in enumerate(ids) if i not in self.silent), None)
        surface = self.surface
        raw = b"".join([surface[i] for i in ids])
        drop = first is not None and ids[first] in self.strips
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._mended(ids)
        return text[1:] if drop else text

    def _mended(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i in self.is_byte:
                run += self.surface[i]
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:n]).decode())
                        del run[:n]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    del run[:1]
            if i >= 0 and i not in self.silent:
                out.append(self.surface[i].decode())
        return "".join(out)


_UNITS = re.compile(" *[^ ]+| +")
# A long text is cut behind a character that a blank follows.
_CUT = re.compile("[^ ](?= )")


def _spans(piece: str, made: list[tuple]) -> Iterator[tuple[int, int, int]]:
    """(rank, start, end) of each merge, in order: merges are told again with their places."""
    parts = [(i, i + 1) for i in range(len(piece))]
    for rank, left, right in made:
        for k in range(len(parts) - 1):
            (a, b), (c, d) = parts[k], parts[k + 1]
            if piece[a:b] == left and piece[c:d] == right:
                parts[k : k + 2] = [(a, d)]
                yield rank, a, d
                break


# -- tables --------------------------------------------------------------------------------


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(a) for a in arrays)])
    flat = np.concatenate([np.empty(0, np.uint16), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of each row of ``docs`` (doc_id, text), as the sentencepiece library gives them.

    ``path`` names a model file that every executor has. No begin or end ids, no sampling; names
    of control pieces inside a text are text. A null text is empty and has no ids; a null doc_id stays null;
    repeated rows stay; other columns are ignored; an empty table gives an empty one. One pass,
    no shuffle; a worker holds one batch, and four bytes a character of its longest unit.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            (texts,) = columns_of(batch, "text")
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists([model.encode(t) for t in texts])], names=["doc_id", "ids"])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return text.mapInArrow(run, "doc_id long, ids array<int>")


def decode_pieces(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of each row of ``rows`` (doc_id, ids): the text that the ids decode to.

    Null ids are no ids and give the empty text; a null among the ids is skipped; repeated rows
    stay; other columns are ignored; an empty table gives an empty one.
    """
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            ids = batch.column(1)
            flat, ends = ids.values.to_numpy(zero_copy_only=False).tolist(), ids.offsets.to_numpy().tolist()
            texts = [model.decode(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    ids = F.filter(F.coalesce(F.col("ids").cast("array<int>"), F.array().cast("array<int>")), lambda i: i.isNotNull())
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(
        run, "doc_id long, ids array<int>, text string"
    )


def op11_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """The contract's digest: ids of all ``documents`` and the texts that they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    back = decode_pieces(encode_pieces(docs, path), path)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
