"""The calls as a table in buckets by the unique key: a load does not shuffle what is stored.

The table is partitioned by month and, inside a month, cut into buckets by the key columns. The
anti-join of a load reads it bucket by bucket; only the batch moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..model import CALLS, DEFAULT_KEY
from ..operators.load import insertar_en_cubos
from ..session import borrar_carpeta, carpeta_de_trabajo
from .ingest import LUGAR, PARTICION


# Rows (of the batch and of the stored side) that a task sorts: months are joined together up to as many in a bucket.
FILAS_POR_TAREA = 500_000


def crear(
    spark: SparkSession, nombre: str, ruta: str | None = None, cubos: int | None = None, key_cols: Sequence[str] = DEFAULT_KEY
) -> None:
    """Create the calls table ``nombre`` (at ``ruta``, or managed) with ``cubos`` buckets a month.

    Without ``cubos`` it is the session's number of shuffle partitions, so that a load
    shuffles its batch once.
    """
    cubos = cubos or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columnas = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CALLS.fields)
    lugar = f" LOCATION '{ruta}'" if ruta else ""
    spark.sql(
        f"CREATE TABLE {nombre} ({columnas}, {PARTICION} string) USING parquet PARTITIONED BY ({PARTICION}) "
        f"CLUSTERED BY ({', '.join(key_cols)}) INTO {cubos} BUCKETS{lugar}"
    )


def forma(spark: SparkSession, nombre: str) -> tuple[int, list[str]]:
    """(buckets, key columns) of a calls table in buckets."""
    filas = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {nombre}").collect()}
    claves = [c.strip(" `") for c in filas["Bucket Columns"].strip("[]").split(",")]
    return int(filas["Num Buckets"]), claves


def nuevas(spark: SparkSession, nombre: str, lote: DataFrame) -> DataFrame:
    """Rows of ``lote`` that an insert-ignore into the table adds; the first by ``ingest.LUGAR`` wins.

    A bucket of all months would be sorted in one task, however large it got. Where the key has the day, a conflict
    needs the same month, so groups of months (``FILAS_POR_TAREA``; a month at least) are joined apart.
    """
    cubos, claves = forma(spark, nombre)
    tabla = spark.table(nombre)
    lugar = [c for c in LUGAR if c in lote.columns]
    orden = lugar + [c for c in lote.columns if c not in claves and c not in lugar]
    if "fecha" not in claves:
        return insertar_en_cubos(tabla, lote, claves, cubos, orden)
    n = F.count(F.lit(1)).alias("n")
    filas = {r[0]: r["n"] for r in lote.groupBy(PARTICION).agg(n).collect()}
    sin_mes = filas.pop(None, 0)
    for mes, mas in tabla.where(F.col(PARTICION).isin(list(filas))).groupBy(PARTICION).agg(n).collect():
        filas[mes] += mas
    partes = [
        insertar_en_cubos(tabla.where(F.col(PARTICION).isin(g)), lote.where(F.col(PARTICION).isin(g)), claves, cubos, orden)
        for g in _grupos(filas, cubos * FILAS_POR_TAREA)
    ]
    if sin_mes or not partes:  # no day: the key has a NULL and never conflicts
        partes.append(lote.where(F.col(PARTICION).isNull()))
    return reduce(DataFrame.unionByName, partes)


def _grupos(filas: dict[str, int], tope: int) -> list[list[str]]:
    """Neighbouring months together up to ``tope`` rows."""
    grupos: list[list[str]] = []
    llenas = 0
    for mes in sorted(filas):
        if not grupos or llenas + filas[mes] > tope:
            grupos.append([])
            llenas = 0
        grupos[-1].append(mes)
        llenas += filas[mes]
    return grupos


def cargar(spark: SparkSession, nombre: str, lote: DataFrame) -> int:
    """Insert-ignore ``lote`` (``ingest.buenas``) into the table ``nombre``; returns the rows inserted.

    The batch is written once under the shared checkpoint folder; a load that is repeated adds nothing
    but rows with a NULL in the key, which never conflict.
    """
    copia = carpeta_de_trabajo(spark, "cubos")
    try:
        # by month, so that a group of months reads its own rows; dealt before, so that no task sorts a whole split of the input
        lote.hint("rebalance", PARTICION).write.partitionBy(PARTICION).parquet(copia)
        lote = spark.read.schema(lote.schema).parquet(copia)
        columnas = [f.name for f in CALLS.fields] + [PARTICION]
        obs = Observation("insertadas")
        filas = nuevas(spark, nombre, lote).select(*columnas).observe(obs, F.count(F.lit(1)).alias("filas"))
        filas.write.insertInto(nombre)
        return int(obs.get["filas"])
    finally:
        borrar_carpeta(spark, copia)
