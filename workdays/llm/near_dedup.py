"""Near-duplicate documents: min-max hashing, banding, exact links, components.

1. Each text becomes its set of word shingles (64-bit hashes). Texts with equal sets form a
   class; its smallest doc_id stands for it.
2. Min-max hashing: under each permutation of the hashes both the minimum and the maximum are
   kept, so a signature of 2p values costs p hash evaluations. Bands of ROWS values are hashed
   to keys; classes that share a key are candidates. A pair at the threshold shares no key with
   a probability under 1e-6 (30 bands of 6 values at 0.85, 46 at 0.8).
3. Candidate groups are the components of the stars (class, smallest class) of all keys. Every
   true link lies inside one group.
4. The sets of a group are packed into blocks of BLOCK classes, and pairs of blocks are compared
   exactly, whole sets on both sides, wherever Spark places them: a large group is many small
   tasks, and no pair of documents is ever a row unless it is a link that joins two parts.
5. The links' components give each class, and by it each document, its component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, columns_of, in_pieces, staged, text_or_empty
from .graph import components
from .hashing import mix64, word_shingles

ROWS = 6
# A block holds about this many classes, or this many hashes.
BLOCK = 256
BLOCK_HASHES = 1 << 18
_CHUNK = 2048

_SETS = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("keys", pa.list_(pa.int64())),
     ("mark", pa.int64())]
)
_MEMBER = pa.schema(
    [("root", pa.int64()), ("blocks", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()), ("hashes", pa.binary())]
)
_PACKED = pa.schema([("root", pa.int64()), ("blocks", pa.int32()), ("block", pa.int32()), ("packed", pa.binary())])
_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def bands_for(threshold: float) -> int:
    """Bands of ROWS values so that a pair at the threshold is missed with probability under 1e-6."""
    return int(np.ceil(np.log(1e-6) / np.log(1.0 - threshold**ROWS)))


def multipliers(n: int) -> np.ndarray:
    """Odd factors: multiplying by one permutes the 64-bit numbers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def min_max(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minimum and maximum under each permutation, side by side."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(len(factors), dtype=np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        v = hashes[at : at + _CHUNK, None] * factors
        np.minimum(low, v.min(axis=0), out=low)
        np.maximum(high, v.max(axis=0), out=high)
    return np.stack((low, high), axis=1).ravel()


def band_keys(hashes: np.ndarray, bands: int) -> np.ndarray:
    values = min_max(hashes, multipliers(bands * ROWS // 2)).reshape(bands, ROWS)
    keys = np.arange(bands, dtype=np.uint64)
    for j in range(ROWS):
        keys = mix64(keys + values[:, j])
    return keys.view(np.int64)


def block_links(left: list[np.ndarray], right: list[np.ndarray] | None, threshold_pct: int) -> list[tuple[int, int]]:
    """Linked pairs (place in left, place in right); ``right`` None: pairs inside ``left``.

    The sets become rows of a 0/1 matrix over their shingles, cut into slices of columns;
    products of the slices add up to the sizes of all intersections.
    """
    own = left if right is None else left + right
    sizes = np.array([len(s) for s in own])
    _, place = np.unique(np.concatenate(own), return_inverse=True)
    who = np.repeat(np.arange(len(own)), sizes)
    n, width = len(left), 4096
    order = np.argsort(place, kind="stable")
    place, who = place[order], who[order]
    both = np.zeros((n, n if right is None else len(right)), dtype=np.float64)
    cuts = np.searchsorted(place, np.arange(0, int(place[-1]) + width + 1, width)) if len(place) else [0]
    for k in range(len(cuts) - 1):
        m = np.zeros((len(own), width), dtype=np.float32)
        m[who[cuts[k] : cuts[k + 1]], place[cuts[k] : cuts[k + 1]] - k * width] = 1.0
        both += m[:n] @ (m[:n] if right is None else m[n:]).T
    union = sizes[:n, None] + (sizes[:n] if right is None else sizes[n:])[None, :] - both
    hit = 100 * both >= threshold_pct * union
    if right is None:
        hit = np.triu(hit, 1)
    return list(zip(*(x.tolist() for x in np.nonzero(hit)), strict=True))


def forest(pairs: list[tuple[int, int]], a: list[int], b: list[int]) -> Iterator[tuple[int, int]]:
    """Of the links between two blocks, those that join parts not joined yet: fewer than their members."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in pairs:
        x, y = find(a[i]), find(b[j])
        if x != y:
            parent[max(x, y)] = min(x, y)
            yield a[i], b[j]


def pack_block(ids: list[int], sets: list[np.ndarray]) -> bytes:
    """A block of sets: its distinct shingles once, then each set as places among them, compressed."""
    sizes = np.array([len(x) for x in sets], dtype="<i8")
    distinct, places = np.unique(np.concatenate(sets), return_inverse=True)
    head = np.array([len(ids), len(distinct)], dtype="<i8").tobytes()
    raw = head + np.array(ids, dtype="<i8").tobytes() + sizes.tobytes() + distinct.astype("<u8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw + places.astype("<u4").tobytes())


def unpack_block(packed: bytes) -> tuple[list[int], list[np.ndarray]]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n, d = np.frombuffer(raw, "<i8", 2).tolist()
    ids = np.frombuffer(raw, "<i8", n, 16).tolist()
    sizes = np.frombuffer(raw, "<i8", n, 16 + 8 * n)
    distinct = np.frombuffer(raw, "<u8", d, 16 + 16 * n)
    hashes = distinct[np.frombuffer(raw, "<u4", -1, 16 + 16 * n + 8 * d)]
    return ids, np.split(hashes, np.cumsum(sizes)[:-1])


def _sets_and_keys(docs: DataFrame, k: int, bands: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, keys, mark) of each row; an empty set has no id and no keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, marks = columns_of(batch, "doc_id", "text", "mark")
            sets = [word_shingles(t.encode(), k) for t in texts]
            names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            keys = [band_keys(s, bands) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.int64())],
                schema=_SETS,
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_id binary, keys array<long>, mark long")


def _candidate_groups(classes: DataFrame) -> DataFrame:
    """(node, root): classes (class_id, keys) joined by shared keys, as stars around each key's smallest class."""
    rows = classes.select("class_id", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("class_id").alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = rows.join(shared.select("key", "m"), "key").where("class_id <> m")
    return components(stars.select(F.col("class_id").alias("u"), F.col("m").alias("v")), "near-groups")


def _blocks(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(root, blocks, block, packed): the sets of each group in blocks of about BLOCK classes and BLOCK_HASHES hashes.

    ``members``: (node, root, n_shingles). A class's block is a hash of its id, so no group is ordered.
    """
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("h"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("h") / BLOCK_HASHES)).cast("int")
    sizes = sizes.select("root", blocks.alias("blocks"))
    at = members.join(sizes, "root")
    at = at.select("node", "root", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    texts = docs.join(at, docs["doc_id"] == at["node"]).select("root", "blocks", "block", "doc_id", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (found,) = columns_of(batch, "text")
            sets = [word_shingles(t.encode(), k).tobytes() for t in found]
            keep = [batch.column(batch.schema.get_field_index(c)) for c in ("root", "blocks", "block", "doc_id")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sets, pa.binary())], schema=_MEMBER)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            now, ids, sets = None, [], []
            for batch in batches:
                for *at, doc_id, raw in zip(*columns_of(batch, "root", "blocks", "block", "doc_id", "hashes"), strict=True):
                    if ids and at != now:
                        yield (*now, pack_block(ids, sets))
                        ids, sets = [], []
                    now = at
                    own = np.frombuffer(raw, "<u8")
                    if not ids or ids[-1] != doc_id or not np.array_equal(sets[-1], own):  # repeated rows count once
                        ids.append(doc_id)
                        sets.append(own)
            if ids:
                yield (*now, pack_block(ids, sets))

        return in_pieces(rows(), _PACKED, 8)

    sets = texts.mapInArrow(hashed, "root long, blocks int, block int, doc_id long, hashes binary")
    sets = sets.repartition("root", "block").sortWithinPartitions("root", "block", "doc_id", "hashes")
    return sets.mapInArrow(packed, "root long, blocks int, block int, packed binary")


def _links(blocks: DataFrame, threshold_pct: int) -> DataFrame:
    """(u, v): links inside each block and between the blocks of a group, as forests."""

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for (raw,) in zip(*columns_of(batch, "packed"), strict=True):
                    ids, sets = unpack_block(raw)
                    yield from forest(block_links(sets, None, threshold_pct), ids, ids)

        return in_pieces(rows(), _LINKS)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for left, right in zip(*columns_of(batch, "packed", "other"), strict=True):
                    a, left_sets = unpack_block(left)
                    b, right_sets = unpack_block(right)
                    yield from forest(block_links(left_sets, right_sets, threshold_pct), a, b)

        return in_pieces(rows(), _LINKS)

    large = blocks.where("blocks > 1")
    later = F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)).alias("next")
    left = large.where("block < blocks - 1").select("root", "packed", later)
    right = large.select(F.col("root").alias("r"), F.col("block").alias("b"), F.col("packed").alias("other"))
    pairs = left.join(right, (F.col("root") == F.col("r")) & (F.col("next") == F.col("b"))).select("packed", "other")
    return blocks.select("packed").mapInArrow(inside, "u long, v long").unionAll(pairs.mapInArrow(between, "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold_pct: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Two documents are linked when 100 * common shingles >= ``threshold_pct`` * all their
    shingles; ``component_id`` is the smallest doc_id reached over links, ``kept`` marks that
    document. A text of fewer than ``shingle`` words is one shingle; a null text or one without
    words has no shingle and no link. Rows that share a doc_id keep a row each, with the
    component of their own text; a null doc_id has a null component and is kept. Other columns
    are ignored; an empty table gives no rows.
    """
    return _judged(docs, shingle, threshold_pct).drop("mark")


def _judged(docs: DataFrame, shingle: int, threshold_pct: int) -> DataFrame:
    """``near_duplicates`` with the mark (a hash) of each row's text."""
    bounded_batches(docs.sparkSession)
    text = text_or_empty()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    sets = staged(_sets_and_keys(docs, shingle, bands_for(threshold_pct / 100)), "near-sets")
    full = sets.where("doc_id is not null and set_id is not null")
    classes = staged(
        full.groupBy("set_id").agg(F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")),
        "near-classes",
    )
    groups = _candidate_groups(classes)
    members = groups.join(classes.select(F.col("class_id").alias("node"), "n_shingles"), "node")
    blocks = staged(_blocks(docs, members.select("node", "root", "n_shingles"), shingle), "near-blocks")
    parts = components(_links(blocks, threshold_pct), "near-links")
    named = classes.select("set_id", "class_id").join(parts, F.col("class_id") == F.col("node"), "left")
    named = named.select("set_id", F.coalesce("root", "class_id").alias("component_id"))
    # texts without words have no set: they pass by the join, where they would all meet in one task
    cols = ("doc_id", "n_shingles", "mark")
    joined = sets.where("set_id is not null").join(named, "set_id", "left").select(*cols, "component_id")
    alone = sets.where("set_id is null").select(*cols, F.lit(None).cast("long").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = joined.unionAll(alone).select("doc_id", "n_shingles", component.alias("component_id"), "mark")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, shingle: int = 5, threshold_pct: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one for each group of near-duplicates, with all their columns.

    A row goes when its own text is a copy of one with a smaller doc_id, so of rows that share an
    id a different text stays. Rows equal in id and text are one document: the one whose other
    columns have the smallest hash stays. Rows with a null doc_id all stay. A null text is
    empty; an empty table gives an empty one.
    """
    gone = _judged(docs, shingle, threshold_pct).where("doc_id is not null and not kept")
    names = docs.columns
    marked = docs.withColumn("_mark", F.xxhash64(text_or_empty())).withColumn("_id", F.col("doc_id").cast("long"))
    named = marked.where("doc_id is not null")
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    # the anti-join and the grouping share their columns: the texts are shuffled once
    others = [c for c in names if c not in ("doc_id", "text") and not docs.schema[c].dataType.typeName() == "map"]
    first = F.min_by(F.struct(*names), F.xxhash64(*others) if others else F.lit(0))
    left = named.join(gone, ["_id", "_mark"], "left_anti").groupBy("_id", "_mark").agg(first.alias("_row"))
    return left.select(*[F.col("_row")[c].alias(c) for c in names]).unionAll(docs.where("doc_id is null"))


def op5_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """The contract's digest: all ``documents``, sets of 3-word shingles, links from 85 in 100."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, threshold_pct=85)
