"""Removal of repeated byte strings, by suffix arrays over the places that can repeat.

A string of ``length`` bytes is judged by one of its GRAM-byte substrings, the one with the
smallest hash (the leftmost of equals): equal strings have equal such anchors at equal places.
Consecutive strings with one anchor are a region. So:

1. one pass over the texts gives regions (anchor, hash of the region's bytes, place); regions
   that a task sees twice are settled there, and one of them goes on;
2. sorted by anchor, regions that are equal elsewhere are settled, an anchor that stands alone
   in the corpus drops out, and what is left differs around a common anchor;
3. those regions' bytes, dealt to shards by their anchor, get a suffix array by induced sorting,
   and the permuted common prefixes tell which strings repeat. An anchor with more than HOT
   different regions is split by the hash of each of its strings instead;
4. the settled strings' spans are put together per document and cut out of its text.

Every string meets every other with its anchor, so nothing is lost, and no document, anchor or
shard is held whole but one shard of SHARD_BYTES (or one anchor's HOT regions).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, columns_of, in_pieces, staged, text_or_empty
from .hashing import mix64, powers
from .suffix_array import repeated_starts

LENGTH = 200
GRAM = 32
HOT = 2048
SHARD_BYTES = 1 << 20
# Regions that a task compares among themselves at a time.
HELD_REGIONS = 1 << 19
# Bytes of a text that are hashed at a time.
_PIECE = 1 << 18
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

_REGION = pa.schema(
    [("anchor", pa.int64()), ("body", pa.int64()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()),
     ("count", pa.int32()), ("state", pa.int32())]
)
_REGION_SQL = "anchor long, body long, doc_id long, mark long, start long, count int, state int"
# state: a region that awaits others, one that is known to repeat, a span of settled strings
NEW, REPEATED, SETTLED = 0, 1, 2


def text_mark(raw: bytes) -> int:
    """Tells apart texts that share a doc_id."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=4).digest(), "little")


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours: block-wise running minima from both sides."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def regions(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor hash, body hash, first start, number of starts) of the regions of a text.

    Long texts go in pieces that overlap by ``length`` - 1 bytes; a region that a piece's end
    cuts is two regions, whose strings are judged all the same.
    """
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(raw) - length + 1, _PIECE):
        b = np.frombuffer(raw[at : at + _PIECE + length - 1], np.uint8)
        up, down = powers(len(b))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * up[: len(b)], dtype=np.uint64)))
        grams = mix64((sums[gram:] - sums[:-gram]) * down[: len(b) - gram + 1])
        place = np.arange(len(grams), dtype=np.uint64)
        low = np.uint64((1 << 20) - 1)
        anchor = (_least((grams & ~low) | place, length - gram + 1) & low).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
        count = np.diff(np.append(first, len(anchor)))
        end = first + count + length - 1
        body = mix64((sums[end] - sums[first]) * down[first] + (anchor[first] - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        body = mix64(body + (end - first).astype(np.uint64))
        out.append((grams[anchor[first]].view(np.int64), body.view(np.int64), first + at, count))
    if not out:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in ascending order of start, those that touch or overlap put together."""
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    cut = np.flatnonzero(start[1:] > reach[:-1]) + 1
    return start[np.concatenate(([0], cut))], reach[np.append(cut - 1, len(start) - 1)]


def _find_regions(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Regions of a task's texts; those it meets again are settled as spans of their texts."""
    parts: list[tuple] = []
    held = 0
    for batch in batches:
        for doc_id, text in zip(*columns_of(batch, "doc_id", "text"), strict=True):
            raw = text.encode()
            if len(raw) >= length:
                parts.append((doc_id, text_mark(raw), *regions(raw, length, gram)))
                held += len(parts[-1][2])
        if held >= HELD_REGIONS:
            yield from _combined(parts, length)
            parts, held = [], 0
    if parts:
        yield from _combined(parts, length)


def _combined(parts: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(p[2]) for p in parts])
    anchor, body, start, count = (np.concatenate([p[k] for p in parts]) for k in (2, 3, 4, 5))
    doc = np.repeat(np.arange(len(parts)), sizes)
    order = np.lexsort((body, anchor))
    a, b = anchor[order], body[order]
    fresh = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    group = np.cumsum(fresh) - 1
    often = np.bincount(group) > 1
    ids = pa.array([p[0] for p in parts], pa.int64())
    marks = np.array([p[1] for p in parts], dtype=np.int64)

    def rows(who: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = 1 << 16
        for at in range(0, len(who), step):
            w = who[at : at + step]
            anchors, bodies, starts, counts, state = (c[at : at + step] for c in columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(bodies), ids.take(pa.array(w)), pa.array(marks[w]), pa.array(starts),
                 pa.array(counts.astype(np.int32)), pa.array(state.astype(np.int32))],
                schema=_REGION,
            )

    one = order[fresh]
    yield from rows(doc[one], anchor[one], body[one], start[one], count[one], np.where(often, REPEATED, NEW))
    # every place of a region that repeats here, in the order of texts and places; a text's
    # places are set apart by more than a text is long, so all spans are put together at once
    again = np.sort(order[often[group]])
    if not len(again):
        return
    who, s = doc[again], start[again]
    e = s + count[again] + length - 1
    apart = int(e.max()) + 2
    first, last = _merged(who * apart + s, who * apart + e)
    who = first // apart
    # of a settled span, ``body`` holds the end; its ``anchor`` only spreads the rows
    spread = mix64(first.astype(np.uint64)).view(np.int64)
    yield from rows(who, spread, last - who * apart, first - who * apart, np.zeros_like(who), np.full(len(who), SETTLED))


def _meet(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, body): settle equal regions, give on one of each anchor with several.

    Only the first row of the current body and of the current anchor is held.
    """

    def span(row: tuple) -> tuple:
        return 0, row[4] + row[5] + length - 1, row[2], row[3], row[4], 0, SETTLED

    def rows():
        now = None  # first row of the current (anchor, body)
        told = alone = False  # whether ``now`` is settled; whether it is the anchor's first body
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[6] == SETTLED:
                    yield row
                    continue
                if now is not None and row[0] == now[0] and row[1] == now[1]:
                    if not told:
                        yield span(now)
                        told = True
                    yield span(row)
                    continue
                if now is not None and row[0] == now[0]:
                    if alone:
                        yield (*now[:6], REPEATED if told or now[6] == REPEATED else NEW)
                    alone, told, now = False, row[6] == REPEATED, row
                    # a later row may still settle this body; its strings are then judged twice, to the same end
                    yield (*row[:6], row[6])
                    continue
                now, alone, told = row, True, row[6] == REPEATED

    return in_pieces(rows(), _REGION, 4096)


_BYTES = pa.schema(
    [("anchor", pa.int64()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("state", pa.int32()), ("raw", pa.binary())]
)
_SPAN = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_SPAN_SQL = "doc_id long, mark long, start long, end long"


def _cut_bytes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked regions of each text."""

    def rows():
        for batch in batches:
            for doc_id, text, asked in zip(*columns_of(batch, "doc_id", "text", "asked"), strict=True):
                raw = text.encode()
                mark = text_mark(raw)
                for r in asked:
                    if r["mark"] == mark:
                        piece = raw[r["start"] : r["start"] + r["count"] + length - 1]
                        yield r["anchor"], doc_id, mark, r["start"], r["state"], piece

    return in_pieces(rows(), _BYTES, 2048)


def _sort_shards(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, anchor): suffix arrays of about SHARD_BYTES, never through an anchor."""

    def settle(held: list[tuple]) -> Iterator[tuple]:
        sizes = np.array([len(h[4]) for h in held])
        joined = np.frombuffer(b"\0".join(h[4] for h in held) + b"\0", np.uint8).astype(np.uint16) + 2
        ends = np.cumsum(sizes + 1) - 1
        begins = ends - sizes
        joined[ends] = 1
        valid = np.zeros(len(joined), dtype=bool)
        for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
            valid[a : max(a, b - length + 1)] = True
        hit = repeated_starts(joined, valid, length)
        for k, (_, doc_id, mark, start, _) in enumerate(held):
            own = np.flatnonzero(hit[begins[k] : ends[k]]) + start
            for s, e in zip(*_merged(own, own + length), strict=True):
                yield doc_id, mark, int(s), int(e)

    def rows():
        held, size, anchor = [], 0, None
        for batch in batches:
            names = ("anchor", "doc_id", "mark", "start", "raw")
            for row in zip(*columns_of(batch, *names), strict=True):
                if row[0] != anchor and size >= SHARD_BYTES:
                    yield from settle(held)
                    held, size = [], 0
                anchor = row[0]
                held.append(row)
                size += len(row[4])
        if held:
            yield from settle(held)

    return in_pieces(rows(), _SPAN, 4096)


def _split_hot(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """One row for each string of the regions of hot anchors: its 128-bit hash and its place."""

    def rows():
        for batch in batches:
            for doc_id, mark, start, raw in zip(*columns_of(batch, "doc_id", "mark", "start", "raw"), strict=True):
                for k in range(len(raw) - length + 1):
                    yield hashlib.blake2b(raw[k : k + length], digest_size=16).digest(), doc_id, mark, start + k

    schema = pa.schema([("string", pa.binary()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64())])
    return in_pieces(rows(), schema, 4096)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, mark, start, end): spans of bytes that some repeated string covers, not yet put together."""
    found = docs.mapInArrow(lambda b: _find_regions(b, length, gram), _REGION_SQL)
    met = found.repartition("anchor").sortWithinPartitions("anchor", "body")
    met = staged(met.mapInArrow(lambda b: _meet(b, length), _REGION_SQL), "repeats-met")
    spans = [met.where(F.col("state") == SETTLED).select("doc_id", "mark", "start", F.col("body").alias("end"))]
    left = met.where(F.col("state") != SETTLED)
    per_anchor = left.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("count") + F.lit(length - 1)).alias("bytes"))
    per_anchor = staged(per_anchor.select("anchor", "bytes", (F.col("n") > HOT).alias("hot")), "repeats-anchors")
    todo, any_hot = per_anchor.agg(F.sum(F.when(~F.col("hot"), F.col("bytes"))), F.max("hot")).first()
    asked = left.groupBy("doc_id").agg(F.collect_list(F.struct("mark", "anchor", "start", "count", "state")).alias("asked"))
    asked = asked.withColumnRenamed("doc_id", "d")
    cut = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("d"))).select("doc_id", "text", "asked")
    cut = cut.mapInArrow(lambda b: _cut_bytes(b, length), "anchor long, doc_id long, mark long, start long, state int, raw binary")
    if any_hot:
        cut = staged(cut, "repeats-bytes")
        hot = per_anchor.where("hot").select("anchor")
        strings = cut.join(hot, "anchor", "left_semi").mapInArrow(
            lambda b: _split_hot(b, length), "string binary, doc_id long, mark long, start long"
        )
        strings = staged(strings, "repeats-strings")
        often = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
        again = strings.join(often, "string").select("doc_id", "mark", "start", (F.col("start") + length).alias("end"))
        spans.append(again)
        cut = cut.join(hot, "anchor", "left_anti")
    shards = max(1, -(-int(todo or 0) // SHARD_BYTES))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).repartition(shards, "shard")
    sorted_rows = dealt.sortWithinPartitions("shard", "anchor", "doc_id", "start").drop("shard", "state")
    spans.append(sorted_rows.mapInArrow(lambda b: _sort_shards(b, length), _SPAN_SQL))
    out = spans[0]
    for s in spans[1:]:
        out = out.unionAll(s)
    return out


_CLEAN = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()),
     ("kept_sha256", pa.string())]
)


def without_repeats(docs: DataFrame, length: int = LENGTH, keep_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) for each row of ``docs`` (doc_id, text).

    Each byte that some string of ``length`` bytes covers which also starts anywhere else, in the
    same text or another, is removed; matches never cross texts and are judged on the input.
    ``kept`` holds the other bytes (null if ``keep_text`` is off). A null text is empty; texts
    shorter than ``length`` stay whole; rows that repeat remove each other, also with equal or
    null doc_ids; other columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    spans = staged(repeated_spans(docs, length), "repeats-spans")
    per_doc = spans.groupBy(F.col("doc_id").alias("d")).agg(F.collect_list(F.struct("mark", "start", "end")).alias("spans"))
    joined = docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col("d")), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc_id, text, found in zip(*columns_of(batch, "doc_id", "text", "spans"), strict=True):
                    raw = text.encode()
                    mark = text_mark(raw) if found else 0
                    own = np.array(sorted((s["start"], s["end"]) for s in found or () if s["mark"] == mark), dtype=np.int64).reshape(-1, 2)
                    first, last = _merged(own[:, 0], own[:, 1])
                    at, parts = 0, []
                    for a, b in zip(first.tolist(), last.tolist(), strict=True):
                        parts.append(raw[at:a])
                        at = b
                    kept = b"".join([*parts, raw[at:]])
                    sha = hashlib.sha256(kept).hexdigest()
                    yield doc_id, len(raw), len(raw) - len(kept), len(first), kept if keep_text else None, sha

        return in_pieces(rows(), _CLEAN)

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def op6_repeated_strings(spark, sf_dir: str) -> DataFrame:
    """The contract's digest of all ``documents``."""
    clean = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_text=False)
    return clean.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
