"""Token counts with overlap resynchronisation for huge documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import bounded_batches, columns_of, in_pieces, text_or_empty

# Texts with more code points than this are encoded in overlapping chunks.
CHUNK = 16_384
OVERLAP = 256
LIMIT = 512

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("n_chunks", pa.int64())])


def count_text(text: str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int]:
    """(tokens, chunks) of one text, as the library counts the whole text without added tokens.

    A text of up to ``chunk`` code points is one chunk; the others are spliced.
    """
    if len(text) > chunk:
        parts = [len(ids) for ids in tokens.spliced(text, tokens.load(path), chunk, overlap)]
        return sum(parts), len(parts)
    if tokens.Units.fits(path):
        return len(tokens.units(path).ids(text)) // 2, 1
    return len(tokens.load(path).encode(text, add_special_tokens=False).ids), 1


def token_counts(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_chunks) for each row of ``docs`` (doc_id, text).

    ``path`` names a file of the tokenizers library that every executor has. A null text is
    empty and has 0 tokens; a null doc_id stays null; repeated rows stay; other columns are
    ignored. One pass over the text, no shuffle; a worker holds one batch and one chunk.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc_id, text in zip(*columns_of(batch, "doc_id", "text"), strict=True):
                    yield doc_id, len(text.encode()), *count_text(text, path, chunk, overlap)

        return in_pieces(rows(), _OUT)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, n_chunks long"
    )


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    """The contract's digest: counts of all ``documents`` with the byte-level 50k vocabulary."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "n_chunks")
