"""Insert-ignore load (K2): append rows whose key is not present yet; first row wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _key_not_null(key_cols: Sequence[str]):
    cond = F.lit(True)
    for k in key_cols:
        cond = cond & F.col(k).isNotNull()
    return cond


def _primero(batch: DataFrame, key_cols: list[str], order_cols: Sequence[str] | None) -> DataFrame:
    """First row per key (see ``primero_por_clave``), computed in ONE aggregation.

    Rows with a NULL key component get a unique id as an extra grouping column,
    so they are never merged (and spread evenly over the shuffle instead of
    hashing together). Callers split on ``_nulo`` afterwards; both sides of that
    split read the same shuffle output, so the batch itself is computed once.
    """
    other = [c for c in batch.columns if c not in key_cols]
    order = [c for c in (order_cols or other) if c not in key_cols]
    rest = [c for c in other if c not in order]
    nulo = F.when(~_key_not_null(key_cols), F.monotonically_increasing_id())
    grupo = [F.xxhash64(*key_cols).alias("_h"), *key_cols, nulo.alias("_nulo")]
    if not other:
        return batch.groupBy(*grupo).agg(F.count(F.lit(1)).alias("_n")).select(*key_cols, "_nulo")
    # The struct minimum runs as a sort-based aggregate; leading the grouping with
    # a 64-bit hash of the key (a function of it, so the groups are the same) lets
    # the sort compare one long before it compares the key's text columns.
    return (
        batch.groupBy(*grupo)
        .agg(F.min(F.struct(*order, *rest)).alias("_fila"))
        .select(*key_cols, "_nulo", *[F.col(f"_fila.{c}").alias(c) for c in order + rest])
    )


def primero_por_clave(
    batch: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str] | None = None
) -> DataFrame:
    """One row per key inside a batch: the first by ``order_cols`` then every other column.

    Deterministic (D24): ties on ``order_cols`` are broken by the remaining columns.
    Runs as ``min(struct(...))`` per key, a two-phase aggregate: duplicates are
    collapsed map-side before the shuffle, so a key holding a third of the rows
    ships one row per map task, not all of them.
    Rows with a NULL key component never conflict (a SQL unique index admits
    several NULLs) and are all kept.
    """
    key_cols = list(key_cols)
    return _primero(batch, key_cols, order_cols).select(*batch.columns)


def insertar_ignorando(
    target: DataFrame,
    batch: DataFrame,
    key_cols: Sequence[str],
    order_cols: Sequence[str] | None = None,
    acotar_por: str | None = None,
) -> DataFrame:
    """K2 + J5: the rows of ``batch`` an ``INSERT IGNORE`` into ``target`` would add.

    The first row of each key is kept (``primero_por_clave``), then keys already in ``target`` are
    skipped with a left anti-join that reads only its key columns. The grouping collapses a key
    where the rows are read, before the shuffle, so a key that fills a third of the batch costs a
    row a task; the join needs the same partitioning, so the batch is shuffled once. Rows with a
    NULL key component never conflict: they carry a unique salt, match nothing and hash apart
    instead of into one task.
    ``acotar_por`` names a calendar column of both frames that the key determines: a key
    column such as ``fecha`` (DATE) or a function of one such as the month ``anio_mes``
    ('YYYY-MM'). The target side is then restricted to the values present in the batch
    (one value per day or month of the batch's span).
    """
    key_cols = list(key_cols)
    clave = ["_sal", *key_cols]
    sal = F.xxhash64(*key_cols)
    existentes = target.select(*key_cols)
    if acotar_por is not None:
        valores = batch.select(acotar_por).where(F.col(acotar_por).isNotNull()).distinct()
        extra = [] if acotar_por in key_cols else [acotar_por]
        existentes = target.select(*key_cols, *extra).join(valores, acotar_por, "left_semi").select(*key_cols)
    existentes = existentes.where(_key_not_null(key_cols)).withColumn("_sal", sal)
    unico = F.when(~_key_not_null(key_cols), F.monotonically_increasing_id())
    con_sal = batch.withColumn("_sal", F.coalesce(unico, sal))
    return _primeras(con_sal, clave, key_cols, order_cols).join(existentes, clave, "left_anti").select(*batch.columns)


def _primeras(batch: DataFrame, grupo: Sequence[str], key_cols: Sequence[str], order_cols: Sequence[str] | None) -> DataFrame:
    """First row of each group by ``order_cols``, then every other column."""
    otras = [c for c in batch.columns if c not in grupo]
    if not otras:
        return batch.groupBy(*grupo).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    orden = [c for c in (order_cols or otras) if c not in key_cols]
    resto = [c for c in otras if c not in orden]
    primeras = batch.groupBy(*grupo).agg(F.min(F.struct(*orden, *resto)).alias("_fila"))
    return primeras.select(*grupo, *[F.col(f"_fila.{c}").alias(c) for c in orden + resto])


def insertar_en_cubos(
    tabla: DataFrame,
    batch: DataFrame,
    key_cols: Sequence[str],
    cubos: int,
    order_cols: Sequence[str] | None = None,
) -> DataFrame:
    """``insertar_ignorando`` against a table stored in ``cubos`` buckets by ``key_cols``.

    The stored side is read bucket by bucket and not shuffled: the batch, collapsed to the first
    row of each key, comes to it. Where ``spark.sql.shuffle.partitions`` is the number of
    buckets, that is the batch's only exchange; otherwise its first rows are dealt once more.
    Rows with a NULL key component never conflict and pass by the join.
    """
    key_cols = list(key_cols)
    completas = batch.where(_key_not_null(key_cols))
    primeras = _primeras(completas, key_cols, key_cols, order_cols)
    if int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")) != cubos:
        primeras = primeras.repartition(cubos, *key_cols)
    # an outer join, not an anti-join: the optimizer would move that before the dealing, and shuffle the stored side
    guardadas = tabla.where(_key_not_null(key_cols)).select(*key_cols, F.lit(True).alias("_guardada"))
    nuevas = primeras.join(guardadas, key_cols, "left").where(F.col("_guardada").isNull())
    return nuevas.select(*batch.columns).unionByName(batch.where(~_key_not_null(key_cols)))
