"""Row filters: active rows, period and programme, exclusions and rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import Period


def activos(df: DataFrame, flag: str = "activo") -> DataFrame:
    """Rows whose ``activo`` flag is 1."""
    return df.where(F.col(flag) == 1)


def periodo_cond(period: Period, col: str = "fecha") -> Column:
    """P3 as a half-open range on the date column, so the scan can push it down.

    ``year(fecha) = y AND month(fecha) = m`` wraps the column and is not pushed.
    """
    c = F.col(col)
    return (c >= F.lit(period.first)) & (c < F.lit(period.next_first))


# Month partition column of the stored calls table ('YYYY-MM').
PARTICION_MES = "anio_mes"


def en_periodo(df: DataFrame, period: Period | None, col: str = "fecha") -> DataFrame:
    """Keep one month; ``None`` keeps the whole series.

    On the stored calls table (partitioned by ``anio_mes``) the month is also
    required of the partition column, so only that folder is listed and read.
    """
    if period is None:
        return df
    cond = periodo_cond(period, col)
    if PARTICION_MES in df.columns:
        cond = cond & (F.col(PARTICION_MES) == F.lit(period.key))
    return df.where(cond)


def de_programa(df: DataFrame, programa: object | None, col: str = "programa_id") -> DataFrame:
    """P5: keep one programme; ``None`` keeps all."""
    return df if programa is None else df.where(F.col(col) == F.lit(programa))


def excluir_agentes(df: DataFrame, nombres: Iterable[object], col: str = "log_name") -> DataFrame:
    """``log_name <> a AND log_name <> b ...``; like SQL ``<>`` it also drops NULL names."""
    cond = F.col(col).isNotNull()
    for n in nombres:
        cond = cond & (F.col(col) != F.lit(n))
    return df.where(cond)


def es_miembro(df: DataFrame, elegidos: DataFrame | Iterable[object], col: str = "log_name") -> DataFrame:
    """``col IN (list)`` as a semi-join; an empty list keeps no rows."""
    if not isinstance(elegidos, DataFrame):
        valores = list(elegidos)
        if not valores:
            return df.limit(0)
        return df.where(F.col(col).isin(valores))
    return df.join(elegidos.select(col).distinct(), on=col, how="left_semi")


def anio_mes(col: str = "fecha") -> Column:
    """``YYYY-MM`` text of a date column."""
    return F.date_format(F.col(col), "yyyy-MM")


def aplicar_reglas(calls: DataFrame, reglas: DataFrame | None) -> DataFrame:
    """Drop calls of an agent in a programme-month listed in ``reglas``.

    ``reglas`` has (programa_id, anio_mes 'YYYY-MM', log_name); a NULL
    programa_id makes the rule hold in every programme. As with the
    ``log_name <> ..`` predicates it replaces, calls with a NULL name are also
    dropped, but only in programme-months that have a rule (D8). Both steps are
    joins against the rules table, which Spark broadcasts when its statistics show
    that it is small, so the calls then stream through without a shuffle.
    """
    if reglas is None:
        return calls
    # Month as the integer yyyymm on both sides: an integer join key, no text per call row.
    keyed = calls.withColumn("_mes", F.year("fecha") * 100 + F.month("fecha"))
    mes_regla = F.regexp_replace(F.col("anio_mes"), "-", "").try_cast("int").alias("_mes")
    reglas = reglas.select("programa_id", mes_regla, "log_name")
    prog = F.col("programa_id").isNotNull()
    # Rules for one programme, and rules with a NULL programme, which hold for all.
    r = reglas.where(prog & F.col("log_name").isNotNull()).distinct().withColumn("_excluido", F.lit(True))
    rg = (
        reglas.where(~prog & F.col("log_name").isNotNull())
        .select("_mes", "log_name")
        .distinct()
        .withColumn("_excluido_g", F.lit(True))
    )
    ruled = reglas.where(prog).select("programa_id", "_mes").distinct().withColumn("_con_regla", F.lit(True))
    ruled_g = reglas.where(~prog).select("_mes").distinct().withColumn("_con_regla_g", F.lit(True))
    # Lookups in one pass over the calls.
    # (Plain joins also compare collated names by their collation key.)
    out = keyed.join(r, on=["programa_id", "_mes", "log_name"], how="left")
    out = out.join(rg, on=["_mes", "log_name"], how="left")
    out = out.join(ruled, on=["programa_id", "_mes"], how="left")
    out = out.join(ruled_g, on=["_mes"], how="left")
    con_regla = F.col("_con_regla").isNotNull() | F.col("_con_regla_g").isNotNull()
    keep = (
        F.col("_excluido").isNull()
        & F.col("_excluido_g").isNull()
        & ~(con_regla & F.col("log_name").isNull())
    )
    return out.where(keep).select(*calls.columns)


def programa_por_id(programas: DataFrame, programa_id: object) -> dict:
    """Look one programme up by id (one-row dimension lookup).

    Returns monitor name, output name and folder with NULL read as ''.
    Raises ``KeyError`` for an unknown id.
    """
    rows = (
        programas.where(F.col("id") == F.lit(programa_id))
        .select(
            "id",
            "nombre_monitor",
            F.coalesce(F.col("nombre_salida"), F.lit("")).alias("nombre_salida"),
            F.coalesce(F.col("directorio"), F.lit("")).alias("directorio"),
        )
        .limit(2)
        .collect()
    )
    if not rows:
        raise KeyError(f"unknown programme id {programa_id!r}")
    return rows[0].asDict()
