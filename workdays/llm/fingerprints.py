"""Document fingerprints by one-permutation MinHash.

A text's shingles are hashed once. The top bits of a hash name its bin, and a bin keeps its
smallest hash. Empty bins borrow by optimal densification: bin i tries the bins that a hash of
(i, 1), (i, 2), ... names until one is filled, the same walk for every text. Of each bin only
the low bits are stored; two fingerprints then agree in a bin by chance with probability
2**-bits, which the estimate takes out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, bounded_batches, bucket_of, columns_of, id_bounds, in_pieces, shuffle_partitions, text_or_empty
from .hashing import mix64, powers

BINS_LOG2 = 9
BITS = 4
# Code points of a shingle; a text starts with as many blanks less one, so short texts have shingles too.
SHINGLE = 8
_PIECE = 1 << 17

_walks: dict[tuple[int, int], np.ndarray] = {}


def _walk(block: int, bins: int) -> np.ndarray:
    """Bins that each bin tries, 64 steps a block."""
    if (bins, block) not in _walks:
        step = np.arange(64 * block + 1, 64 * block + 65, dtype=np.uint64)
        at = np.arange(bins, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        _walks[bins, block] = (mix64(at + step * np.uint64(0xD1B54A32D192ED03)) % np.uint64(bins)).astype(np.int64)
    return _walks[bins, block]


def shingle_pieces(text: str, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """64-bit hashes of all runs of ``size`` code points of the text behind its leading blanks, piece by piece.

    A run's polynomial is the difference of two prefix sums (mod 2**64) moved back to power 0.
    """
    for at in range(0, len(text), _PIECE):
        own = text[max(0, at - size + 1) : at + _PIECE]
        codes = np.frombuffer(own.encode("utf-32-le"), "<u4").astype(np.uint64)
        if at < size - 1:
            codes = np.concatenate((np.zeros(size - 1 - at, np.uint64), codes))
        x = mix64(codes + np.uint64(1))
        up, down = powers(len(x))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * up[: len(x)], dtype=np.uint64)))
        yield mix64((sums[size:] - sums[:-size]) * down[: len(x) - size + 1])


def sketch(pieces: Iterable[np.ndarray], bins_log2: int = BINS_LOG2) -> np.ndarray | None:
    """Smallest hash of each bin after densification; None for an empty set."""
    bins = 1 << bins_log2
    numbers = np.arange(bins, dtype=np.uint64)
    out = np.zeros(bins, dtype=np.uint64)
    filled = np.zeros(bins, dtype=bool)
    for hashes in pieces:
        if not len(hashes):
            continue
        own = np.sort(hashes)
        first = np.searchsorted(own, numbers << np.uint64(64 - bins_log2))
        least = own[np.minimum(first, len(own) - 1)]
        found = (first < len(own)) & (least >> np.uint64(64 - bins_log2) == numbers)
        out = np.where(found & ~(filled & (out < least)), least, out)
        filled |= found
    if not filled.any():
        return None
    empty, block, least = np.flatnonzero(~filled), 0, out.copy()
    while len(empty):
        tried = _walk(block, bins)[empty]
        hit = filled[tried]
        done = hit.any(axis=1)
        out[empty[done]] = least[tried[done, hit[done].argmax(axis=1)]]
        empty, block = empty[~done], block + 1
    return out


def pack(least: np.ndarray | None, bits: int = BITS) -> bytes:
    """Low bits of each bin's minimum, packed; an empty text has an empty fingerprint."""
    if least is None:
        return b""
    low = (mix64(least) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    return np.packbits(np.unpackbits(low[:, None], axis=1)[:, 8 - bits :]).tobytes()


def fingerprint(text: str, bins_log2: int = BINS_LOG2, bits: int = BITS) -> bytes:
    return pack(sketch(shingle_pieces(text), bins_log2), bits)


def likeness(a: bytes, b: bytes, bits: int = BITS) -> float:
    """Estimated Jaccard similarity of two fingerprints, freed of chance agreement, within 0 and 1.

    Two empty texts are alike (1), an empty and a non-empty one are not (0).
    """
    if not a or not b:
        return float(a == b)
    x = np.unpackbits(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)).reshape(-1, bits)
    agree = 1.0 - x.any(axis=1).mean()
    chance = 2.0**-bits
    return float(min(1.0, max(0.0, (agree - chance) / (1.0 - chance))))


def fingerprints(docs: DataFrame, bins_log2: int = BINS_LOG2, bits: int = BITS) -> DataFrame:
    """(doc_id, fingerprint) for each row of ``docs`` (doc_id, text), base64; one pass, no shuffle.

    A null or empty text has the empty fingerprint; repeated rows stay; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = columns_of(batch, "doc_id", "text")
            prints = [base64.b64encode(fingerprint(t, bins_log2, bits)).decode() for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    own = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return own.mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, bucket, ahead) in buckets of doc_id, each bucket with the row that follows it.

    The row behind a bucket (the first row of the next one, or the first of all) is there a second
    time with ``ahead`` 1. Texts are shuffled once, to even ranges of ids.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    low, bounds = id_bounds(docs, "doc_id", 4 * shuffle_partitions(docs.sparkSession))
    starts = np.array(bounds, dtype=np.int64)

    lowest = NULL_ID if low is None else low

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        # twice the bucket, and 1 more where the row stands behind that bucket
        whole = ids.to_numpy(dtype=np.int64)
        own, first = bucket_of(whole, bounds), np.isin(whole, starts)
        last = 2 * len(bounds) + 1
        return pd.Series(
            [[2 * b] + ([2 * b - 1] if f else []) + ([last] if i == lowest else []) for b, f, i in zip(own, first, whole, strict=True)]
        )

    rows = docs.select("doc_id", "text", F.explode(places(F.coalesce("doc_id", F.lit(NULL_ID)))).alias("_p"))
    return rows.select("doc_id", "text", F.shiftright("_p", 1).alias("bucket"), (F.col("_p") % 2).alias("ahead"))


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and how alike they and the next text's are.

    The edited text has its last quarter replaced by the start of the next document (ascending
    doc_id, then text; after the last, the first with an id). Rows with a null doc_id come first;
    a table of one row is its own next; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    ordered = with_next(docs).repartition("bucket").sortWithinPartitions("bucket", "ahead", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held = None  # (bucket, doc_id, text, fingerprint)
            for batch in batches:
                for doc_id, text, bucket, ahead in zip(*columns_of(batch, "doc_id", "text", "bucket", "ahead"), strict=True):
                    if ahead and (held is None or held[0] != bucket):
                        continue  # only the first row behind a bucket counts
                    own = fingerprint(text)
                    if held is not None and held[0] == bucket:
                        yield result(held, text, own)
                    held = None if ahead else (bucket, doc_id, text, own)

        return in_pieces(rows(), _OUT)

    def result(held: tuple, following: str, next_print: bytes) -> tuple:
        _, doc_id, text, own = held
        n, cut = len(text), len(text) // 4
        changed = text[: n - cut] + following[:cut]
        edited = fingerprint(changed)
        b64 = [base64.b64encode(x).decode() for x in (own, edited)]
        sha = hashlib.sha256(changed.encode()).hexdigest()
        return doc_id, n, sha, *b64, likeness(own, edited), likeness(own, next_print)

    return ordered.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    """The contract's digest over all ``documents``."""
    return edited_pairs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
