"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as words: lower-case runs of letters and digits, one space between. A test
item may differ in ``errors`` code points (a share of its length) from a passage. Cut into
errors + 1 pieces, at least one piece of such a passage is untouched: an Aho-Corasick automaton
finds all exact piece hits in one pass over a document, and around each hit Myers' bit-parallel
edit distance decides. A short item, with no edit allowed, is one piece, found at word borders.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, columns_of, in_pieces, text_or_empty

# Edits allowed, as a share of an item's code points.
ERROR_RATE = 0.06
# Items with fewer bytes (UTF-8 of the plain text) match only a document that is nothing else; 0: all items are passages.
MIN_BYTES = 0
# Items matched in one pass over the documents; more items take more passes.
BLOCK_ITEMS = 2000

_WORD = re.compile(r"[^\W_]+")
_BETWEEN = re.compile(r"[\W_]+")
# Letters of scripts that put no space between words (Thai, Lao, Tibetan, Burmese, Khmer and their
# neighbours, kana, bopomofo, Han): each is a word of its own.
_UNSPACED = re.compile(
    "[\u0e00-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u1b00-\u1b7f\u2e80-\u312f\u31a0-\u31ff"
    "\u3400-\u4dbf\u4e00-\ua4cf\ua980-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]"
)
_OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("distance", pa.int32())])


def plain(text: str) -> str:
    return _BETWEEN.sub(" ", text.lower()).strip(" ")


def spread(text: str) -> tuple[str, list[int], list[tuple[int, int]]]:
    """(plain text, start of each word in it, span of each word in ``text``)."""
    words, starts, spans, at = [], [], [], 0
    for m in _WORD.finditer(text):
        for w in _WORD.findall(m.group().lower()):  # lower case can split a character in two
            words.append(w)
            starts.append(at)
            spans.append(m.span())
            at += len(w) + 1
    return " ".join(words), starts, spans


def myers(pattern_bits: dict[str, int], m: int, text: str) -> list[int]:
    """For each end in ``text``: least edit distance of the pattern to a substring that ends there."""
    top, mask = 1 << (m - 1), (1 << m) - 1
    pv, mv, score, out = mask, 0, m, []
    get = pattern_bits.get
    for ch in text:
        eq = get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & mask)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & mask
        pv = ((mh << 1) & mask) | (~(xv | ph) & mask)
        mv = ph & xv
        out.append(score)
    return out


def _border(p: str, at: int) -> bool:
    """Whether no word of the plain text ``p`` goes on across ``at``."""
    return at in (0, len(p)) or " " in p[at - 1 : at + 1] or _UNSPACED.search(p, at - 1, at + 1) is not None


def _bits(pattern: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        found[ch] = found.get(ch, 0) | 1 << i
    return found


@dataclass
class Item:
    item_id: int
    text: str
    errors: int
    whole_words: bool
    forward: dict[str, int] = field(default_factory=dict)
    backward: dict[str, int] = field(default_factory=dict)


class Matcher:
    """The automaton and the bit masks of one block of items."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_bytes: int = MIN_BYTES):
        self.items: list[Item] = []
        self.alone: dict[str, list[int]] = {}
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            p = plain(text)
            if not p:
                continue
            if len(p.encode("utf-8", "replace")) < min_bytes:
                self.alone.setdefault(p, []).append(item_id)
                continue
            errors = int(error_rate * len(p))
            k = len(self.items)
            self.items.append(Item(item_id, p, errors, not errors, _bits(p), _bits(p[::-1])))
            for j in range(errors + 1):
                a, b = j * len(p) // (errors + 1), (j + 1) * len(p) // (errors + 1)
                pieces.setdefault(p[a:b], []).append((k, a))
        self.automaton = ahocorasick.Automaton()
        for piece, at in pieces.items():
            self.automaton.add_word(piece, (len(piece), at))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, distance) of the passages of ``text`` that match, in code points of ``text``."""
        p = plain(text)
        found = [(i, 0, len(text), 0) for i in self.alone.get(p, ())]
        if self.empty:
            return found
        tried: dict[int, list[tuple[int, int]]] = {}
        spans: list[tuple[int, int, int, int]] = []
        for end, (size, at) in self.automaton.iter(p):
            for k, offset in at:
                it = self.items[k]
                origin = end - size + 1 - offset
                if not it.errors:  # the piece is the item
                    if not it.whole_words or _border(p, origin) and _border(p, end + 1):
                        spans.append((k, origin, end + 1, 0))
                    continue
                # every passage of the item with this piece in its place lies in this window
                low, high = max(0, origin - it.errors), min(len(p), origin + len(it.text) + it.errors)
                done = tried.setdefault(k, [])
                if high - low < len(it.text) - it.errors or any(a <= low and high <= b for a, b in done):
                    continue
                done.append((low, high))
                if origin >= 0 and p.startswith(it.text, origin):
                    spans.append((k, origin, origin + len(it.text), 0))
                    done.append((origin - it.errors, origin + len(it.text) + it.errors))
                    continue
                scores = myers(it.forward, len(it.text), p[low:high])
                best = min(scores)
                if best > it.errors:
                    continue
                stop = low + scores.index(best) + 1
                back = myers(it.backward, len(it.text), p[max(low, stop - len(it.text) - it.errors) : stop][::-1])
                spans.append((k, stop - back.index(best) - 1, stop, best))
        if spans:
            whole, starts, places = spread(text)
            if whole == p:
                for k, a, b, d in _separate(spans):
                    first, last = bisect.bisect_right(starts, a) - 1, bisect.bisect_left(starts, b) - 1
                    found.append((self.items[k].item_id, places[max(0, first)][0], places[last][1], d))
            else:  # a lower case that is split otherwise: the span is the whole text
                found += [(self.items[k].item_id, 0, len(text), d) for k, _, _, d in _separate(spans)]
        return found


def _separate(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of overlapping spans of one item, the nearest."""
    kept: dict[int, list[tuple[int, int, int, int]]] = {}
    for s in sorted(spans, key=lambda s: (s[0], s[3], s[1])):
        own = kept.setdefault(s[0], [])  # by start; they do not overlap
        at = bisect.bisect_right(own, s[1], key=lambda t: t[1])
        if (at == 0 or own[at - 1][2] <= s[1]) and (at == len(own) or s[2] <= own[at][1]):
            own.insert(at, s)
    return [s for own in kept.values() for s in own]


_built: dict[tuple, Matcher] = {}


def _matcher(items: tuple, error_rate: float, min_bytes: int) -> Matcher:
    """The matcher of a block, built once per worker."""
    key = (items, error_rate, min_bytes)
    if key not in _built:
        _built.clear()
        _built[key] = Matcher(list(items), error_rate, min_bytes)
    return _built[key]


def blocks_of(benchmark: DataFrame, size: int = BLOCK_ITEMS) -> Iterator[tuple]:
    """The items in blocks of ``size``, by item_id; the driver holds one block at a time."""
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text").distinct().orderBy("item_id", "text")
    held: list[tuple[int, str]] = []
    for item_id, text in rows.toLocalIterator():
        held.append((item_id, text))
        if len(held) == size:
            yield tuple(held)
            held = []
    if held:
        yield tuple(held)


def leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(doc_id, item_id, start, end, distance) of every benchmark passage in a document.

    ``start`` and ``end`` are code points of the text; overlapping matches of one item count
    once, the nearest. Null texts and items match nothing, nor does an item without a letter or digit.
    An item too short for an edit is found as whole words (with ``min_bytes``, one of fewer
    bytes only where it is the whole text); repeated documents are each reported, repeated items once;
    other columns are ignored. An empty benchmark or table gives no rows. One pass over the
    texts for each BLOCK_ITEMS items, no shuffle.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    own = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    schema = "doc_id long, item_id long, start long, end long, distance int"
    found = None
    for items in blocks_of(benchmark):

        def run(batches: Iterator[pa.RecordBatch], items: tuple = items) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(items, error_rate, min_bytes)

            def rows():
                for batch in batches:
                    for doc_id, text in zip(*columns_of(batch, "doc_id", "text"), strict=True):
                        for hit in matcher.find(text):
                            yield doc_id, *hit

            return in_pieces(rows(), _OUT)

        here = own.mapInArrow(run, schema)
        found = here if found is None else found.unionAll(here)
    return found if found is not None else spark.createDataFrame([], schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text holds no passage of the benchmark, with all their columns.

    Null and empty texts stay; repeated rows are each judged; columns of any name are kept as they are;
    an empty benchmark keeps all rows, an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    for items in blocks_of(benchmark):

        def run(batches: Iterator[pa.RecordBatch], items: tuple = items) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(items, error_rate, min_bytes)
            for batch in batches:
                (texts,) = columns_of(batch, "text")
                yield batch.filter(pa.array([not matcher.find(t or "") for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """Passages of ``benchmark`` in all ``documents``, one row each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
