"""Token-id files: one zstandard frame per document under a shared dictionary.

A token folder has two tables. ``dictionary``: one row (dict_sha256, dictionary). ``shards``:
rows of (bucket, seq, first_doc, last_doc, n_docs, n_tokens, dict_sha256, id_bytes, index,
payload); (bucket, seq) ascending is ascending doc_id. ``payload`` holds the frames one after
the other; ``index`` holds one fixed-width entry per document (doc_id, place and length of its
frame, number of ids), so a single short document is read by its entry and one small frame.
The tables are Parquet, written by Spark's committer, so any store that Spark reaches will do.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import tokens
from .common import (
    NULL_ID,
    bounded_batches,
    bucket_of,
    columns_of,
    id_bounds,
    in_pieces,
    joined_batches,
    shuffle_partitions,
    text_or_empty,
    work_folder,
)

END_ID = 2
# The dictionary is trained on about this many documents' ids, each cut to SAMPLE_CHARS code points;
# it only changes how small the frames get.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 8192
DICTIONARY_BYTES = 64 << 10
# A shard row is closed once its frames reach this many bytes.
SHARD_BYTES = 1 << 20
LEVEL = 3

ENTRY = np.dtype([("doc_id", "<i8"), ("null_id", "u1"), ("offset", "<i8"), ("length", "<i8"), ("n_tokens", "<i8")])
_FRAME = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("frame", pa.binary())])
_SHARD = pa.schema(
    [("bucket", pa.int32()), ("seq", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
     ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("dict_sha256", pa.string()), ("id_bytes", pa.int32()),
     ("index", pa.binary()), ("payload", pa.binary())]
)
SHARD_SCHEMA = (
    "bucket int, seq int, first_doc long, last_doc long, n_docs long, n_tokens long, dict_sha256 string, "
    "id_bytes int, index binary, payload binary"
)
_READ = pa.schema(
    [("bucket", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("_start", pa.int64()),
     ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def serialize(text: str, path: str, end_id: int | None = END_ID) -> tuple[bytes, int]:
    """(little-endian ids, bytes per id) of a text with the end id behind it."""
    if tokens.Units.fits(path) and (end_id is None or end_id < 65536):
        raw = tokens.units(path).ids(text)
        return (raw if end_id is None else raw + int(end_id).to_bytes(2, "little")), 2
    ids = tokens.load(path).encode(text, add_special_tokens=False).ids
    return np.array(ids + ([] if end_id is None else [end_id]), dtype="<u4").tobytes(), 4


def serialize_all(texts: pa.Array, path: str, end_id: int | None = END_ID) -> list[bytes]:
    """The bytes that ``serialize`` gives for each of a batch's texts (no nulls)."""
    if tokens.Units.fits(path) and (end_id is None or end_id < 65536):
        end = b"" if end_id is None else int(end_id).to_bytes(2, "little")
        return [raw + end for raw in tokens.units(path).many(texts)]
    return [serialize(t, path, end_id)[0] for t in texts.to_pylist()]


def train_dictionary(docs: DataFrame, path: str, end_id: int | None = END_ID) -> bytes:
    """A dictionary trained on a bounded sample, chosen by a hash of doc_id.

    Too few or too small samples to train on give their own bytes as the content of the
    dictionary; no documents give an empty dictionary.
    """
    n = docs.count()
    kept = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_DOCS / max(1, n)))
    some = docs.where(kept).limit(2 * SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (texts,) = columns_of(batch, "text")
            raw = [serialize(t, path, end_id)[0] for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], names=["raw"])

    some = some.select(F.substring(text_or_empty(), 1, SAMPLE_CHARS).alias("text"))
    samples = sorted(bytes(r[0]) for r in some.mapInArrow(run, "raw binary").collect())
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if len(raw) >= 8 else None


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int | None = END_ID, shard_bytes: int = SHARD_BYTES
) -> None:
    """Encode ``docs`` (doc_id, text) and write them to ``folder`` in ascending doc_id order.

    A null text is empty (its frame holds the end id alone); rows with a null doc_id come first;
    rows that share a doc_id stand side by side, ordered by their frames; other columns are
    ignored; no documents give empty tables. Each document is encoded and compressed once, where
    it is read; only frames are shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    _, bounds = id_bounds(docs, "doc_id", 4 * shuffle_partitions(spark))
    raw_dict = train_dictionary(docs, path, end_id)
    sha = hashlib.sha256(raw_dict).hexdigest()
    spark.createDataFrame([(sha, bytearray(raw_dict))], "dict_sha256 string, dictionary binary").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{folder}/dictionary")
    width = 2 if tokens.Units.fits(path) and (end_id is None or end_id < 65536) else 4

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw_dict))
        for batch in joined_batches(batches, "text"):
            (ids,) = columns_of(batch, "doc_id")
            raw = serialize_all(batch.column(batch.schema.get_field_index("text")), path, end_id)
            buckets = bucket_of(np.array([NULL_ID if i is None else i for i in ids], dtype=np.int64), bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int32()), pa.array(ids, pa.int64()),
                 pa.array([len(r) // width for r in raw], pa.int64()), pa.array([press.compress(r) for r in raw], pa.binary())],
                schema=_FRAME,
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard(bucket: int, seq: int, held: list[tuple]) -> tuple:
            entries = np.zeros(len(held), dtype=ENTRY)
            sizes = np.array([len(h[2]) for h in held], dtype=np.int64)
            entries["doc_id"] = [h[0] or 0 for h in held]
            entries["null_id"] = [h[0] is None for h in held]
            entries["offset"] = np.cumsum(sizes) - sizes
            entries["length"] = sizes
            entries["n_tokens"] = [h[1] for h in held]
            total = int(entries["n_tokens"].sum())
            payload = b"".join(h[2] for h in held)
            ids = [h[0] for h in held if h[0] is not None]  # null ids come first and are in no range
            first, last = (ids[0], ids[-1]) if ids else (None, None)
            return bucket, seq, first, last, len(held), total, sha, width, entries.tobytes(), payload

        def rows():
            bucket, seq, held, size = None, 0, [], 0
            for batch in batches:
                for b, doc_id, n, frame in zip(*columns_of(batch, "bucket", "doc_id", "n_tokens", "frame"), strict=True):
                    if held and (b != bucket or size >= shard_bytes):
                        yield shard(bucket, seq, held)
                        seq, held, size = (seq + 1 if b == bucket else 0), [], 0
                    bucket = b
                    held.append((doc_id, n, frame))
                    size += len(frame)
            if held:
                yield shard(bucket, seq, held)

        return in_pieces(rows(), _SHARD, 1)

    text = docs.select("doc_id", text_or_empty().alias("text"))
    frames = text.mapInArrow(encode, "bucket int, doc_id long, n_tokens long, frame binary")
    ordered = frames.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "n_tokens", "frame")
    ordered.mapInArrow(pack, SHARD_SCHEMA).write.mode("overwrite").parquet(f"{folder}/shards")


def read_dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    """(sha256, dictionary); its size is bounded by DICTIONARY_BYTES."""
    sha, raw = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(bytes(raw)).hexdigest() != sha:
        raise ValueError("the dictionary does not match its hash")
    return sha, bytes(raw)


def shard_ids(row: dict, dictionary: tuple[str, bytes], only: int | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of one shard row; ``only``: of that document alone, without reading the others."""
    if row["dict_sha256"] != dictionary[0]:
        raise ValueError("the shard was written under another dictionary")
    plain = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary[1]))
    index, payload = np.frombuffer(row["index"], dtype=ENTRY), memoryview(row["payload"])
    kind = f"<u{row['id_bytes']}"
    for e in index if only is None else index[(index["doc_id"] == only) & (index["null_id"] == 0)]:
        frame = payload[int(e["offset"]) : int(e["offset"] + e["length"])]
        ids = np.frombuffer(plain.decompress(frame), dtype=kind)
        if len(ids) != e["n_tokens"]:
            raise ValueError("a frame does not hold the ids that its index entry states")
        yield (None if e["null_id"] else int(e["doc_id"])), ids


def read_documents(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """Ids of each document of that id, in file order: its shards are found by the id ranges, its frames by the index."""
    dictionary = read_dictionary(spark, folder)
    hit = spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/shards").where(f"first_doc <= {doc_id} and last_doc >= {doc_id}")
    rows = sorted(hit.collect(), key=lambda r: (r.bucket, r.seq))  # the shards that may hold the one id
    return [ids.tolist() for row in rows for _, ids in shard_ids(row.asDict(), dictionary, doc_id)]


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[int]:
    """Ids of the first document of that id; KeyError if there is none."""
    found = read_documents(spark, folder, doc_id)
    if not found:
        raise KeyError(doc_id)
    return found[0]


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids of all documents before it: sums over the rows of a shard, then
    over the shards of a bucket, then over the buckets (at most four per shuffle partition).
    """
    bounded_batches(spark)
    dictionary = read_dictionary(spark, folder)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/shards")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    at = 0
                    for doc_id, ids in shard_ids(row, dictionary):
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        yield row["bucket"], row["seq"], doc_id, at, len(ids), crc
                        at += len(ids)

        return in_pieces(rows(), _READ)

    docs = shards.mapInArrow(decode, "bucket int, seq int, doc_id long, _start long, n_tokens long, ids_crc32 long")
    up_to = (W.unboundedPreceding, -1)
    in_bucket = F.sum("n_tokens").over(W.partitionBy("bucket").orderBy("seq").rowsBetween(*up_to))
    sizes = shards.select("bucket", "seq", "n_tokens")
    seqs = sizes.select("bucket", "seq", F.coalesce(in_bucket, F.lit(0)).alias("_in"))
    totals = sizes.groupBy("bucket").agg(F.sum("n_tokens").alias("_n"))
    over = F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(*up_to))
    totals = totals.select("bucket", F.coalesce(over, F.lit(0)).alias("_before"))
    base = seqs.join(totals, "bucket").select("bucket", "seq", (F.col("_in") + F.col("_before")).alias("_base"))
    return docs.join(base, ["bucket", "seq"]).select(
        "doc_id", (F.col("_base") + F.col("_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    """The contract's digest, read back from the files of all ``documents``."""
    return tokenize_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def tokenize_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Write ``docs`` to token files in a fresh work folder and return what is read back."""
    import public_tokenizers

    spark = docs.sparkSession
    folder = work_folder(spark, "token-files")
    write_token_files(docs, folder, public_tokenizers.path(vocabulary))
    return read_token_files(spark, folder)
