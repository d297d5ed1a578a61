"""Places in a sorted result without a single task: ranges, counts per range, offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import carpeta_de_trabajo


def numerar(df: DataFrame, orden: Sequence[str], columna: str = "posicion") -> DataFrame:
    """O1/O2: ``df`` with the place (from 1) of each row in the order of ``orden``, NULLs first.

    Rows are dealt to ranges and sorted inside them; that table is written once under the shared
    checkpoint folder, so a lost executor cannot deal them anew. A row's place is the number of
    rows in the ranges before, one number a range through the driver, plus its place in its own.
    """
    spark = df.sparkSession
    ruta = carpeta_de_trabajo(spark, "orden")
    tramo = F.spark_partition_id()
    dentro = F.monotonically_increasing_id() - F.shiftleft(tramo.cast("bigint"), 33)
    rango = df.repartitionByRange(*orden).sortWithinPartitions(*orden)
    rango.select(*df.columns, tramo.alias("_tramo"), dentro.alias("_dentro")).write.parquet(ruta)
    filas = spark.read.parquet(ruta)
    antes, tabla = 0, []
    for t, n in sorted(tuple(r) for r in filas.groupBy("_tramo").count().collect()):
        tabla.append((t, antes))
        antes += n
    base = spark.createDataFrame(tabla, "_tramo int, _antes bigint")
    lugar = (F.col("_antes") + F.col("_dentro") + 1).alias(columna)
    return filas.join(F.broadcast(base), "_tramo").select(*df.columns, lugar)
