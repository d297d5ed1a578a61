"""Helpers shared by the document operators: work folders, ordered buckets, Arrow rows."""

from __future__ import annotations

import atexit
import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import borrar_carpeta, carpeta_de_trabajo

# Largest Arrow batch handed to a Python worker, in rows and in bytes: it bounds a worker's memory.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20

# (session, folder, whether it lasts until the driver ends)
_folders: list[tuple[SparkSession, str, bool]] = []
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package's code to the executors' Python, once per application.

    The archive is written to the shared folder, from which Spark hands it out.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    target = f"{work_folder(spark, 'code', lasting=True)}/workdays.zip"
    where = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def bounded_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in batches of at most ``BATCH_ROWS`` rows or ``BATCH_BYTES`` bytes."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def work_folder(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A fresh folder under the shared folder that ``spark.checkpoint.dir`` names.

    The tables written there outlive executors. They belong to the returned frames,
    so they are removed by ``release`` or at the end of the driver.
    """
    path = carpeta_de_trabajo(spark, f"workdays-llm/{name}")
    _folders.append((spark, path, lasting))
    return path


def release(spark: SparkSession, lasting: bool = False) -> None:
    """Delete the work folders of this session; frames that still read them end with it."""
    for own in [x for x in _folders if x[0] is spark and (lasting or not x[2])]:
        borrar_carpeta(spark, own[1])
        _folders.remove(own)


@atexit.register
def _release_all() -> None:
    for spark in {id(s): s for s, _, _ in _folders}.values():
        try:
            release(spark, lasting=True)
        except Exception:  # the JVM may be gone: nothing is left to delete with
            return


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared work folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = path or work_folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bounds(df: DataFrame, key: str, parts: int) -> tuple[int | None, list[int]]:
    """Smallest non-null ``key`` and ascending bounds that cut it into at most ``parts`` ranges.

    Reads the one column. Bounds are keys that occur, so the first row of each range but the
    first has a bound as its key. The driver gets ``parts`` numbers, whatever the table's size.
    """
    cuts = [i / parts for i in range(1, parts)]
    low, found = df.agg(F.min(key), F.percentile_approx(key, cuts, 20 * parts) if cuts else F.lit(None)).first()
    return low, sorted({b for b in (found or []) if b > low}) if low is not None else []


# Stands for a null id where whole numbers are compared; it is below every bound.
NULL_ID = -(1 << 63)


def bucket_of(ids: np.ndarray, bounds: list[int]) -> np.ndarray:
    """Range of each id: the number of bounds at or below it; NULL_ID is in range 0."""
    return np.searchsorted(np.array(bounds, dtype=np.int64), ids, side="right")


def text_or_empty(column: str = "text") -> F.Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def columns_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def joined_batches(batches: Iterator[pa.RecordBatch], column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches joined until their ``column`` has ``size`` bytes: what is done once a batch is done less often."""
    held, held_bytes = [], 0
    for batch in batches:
        held.append(batch)
        held_bytes += batch.column(batch.schema.get_field_index(column)).nbytes
        if held_bytes >= size:
            joined, held, held_bytes = pa.concat_batches(held), [], 0
            yield joined
    if held:
        yield pa.concat_batches(held)


def in_pieces(rows: Iterator[tuple], schema: pa.Schema, size: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )
