"""Attendance fill (X2): placeholder rows for agents present on a day without calls."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import PLACEHOLDER_CALLER, PLACEHOLDER_RESULT
from ..operators.filters import PARTICION_MES

COLUMNS = ["fecha", "hora", "llamante", "dur", "station", "voice_file", "log_name", "resultado", "programa_id"]


def asistencia(
    calls: DataFrame | None,
    agentes: DataFrame,
    programas: DataFrame,
    presencias: DataFrame,
    acotar_por: str | None = None,
    ventana: tuple[dt.date, dt.date] | None = None,
    en_cualquier_programa: bool = False,
) -> DataFrame:
    """Rows to register for (fecha, programa_id, log_name) presences.

    Each row: ``hora`` = the programme's closing time, the placeholder caller,
    ``dur`` 0, the fixed result text; ``station`` and ``voice_file`` NULL.
    Only names present in ``agentes`` (P7, J4) and existing programmes (J3) get a
    row. With ``calls`` given, presences that already have a call that day for
    that programme are skipped, so only agents who took no calls are filled.
    Joins only: presences x programme by id, never a product of agents and
    programmes.

    The "no call" test is a left outer join to the calls' keys keeping unmatched
    rows. Unlike an anti-join it lets dynamic partition pruning skip call
    partitions the presences do not touch: pass ``acotar_por`` (e.g.
    ``anio_mes``) when the calls table is partitioned by a function of ``fecha``
    and both frames carry it. With ``en_cualquier_programa`` an agent counts as
    having a call when it took one that day in any programme. ``ventana`` (first and last day of the presences,
    when known) restricts the calls read to those days: the filter reaches the
    scan, and on the stored table also its month partitions.
    """
    keys = ["fecha", "programa_id", "log_name"]
    extra = [acotar_por] if acotar_por else []
    claves_llamada = [k for k in keys if not (en_cualquier_programa and k == "programa_id")]
    p = presencias.select(*keys, *extra).distinct()
    p = p.join(agentes.select("log_name"), "log_name", "left_semi")
    prog = programas.select(F.col("id").alias("programa_id"), "hora_fin")
    p = p.join(prog, "programa_id")
    if calls is not None:
        if ventana is not None:
            d0, d1 = ventana
            calls = calls.where(F.col("fecha").between(F.lit(d0), F.lit(d1)))
            if PARTICION_MES in calls.columns:
                calls = calls.where(
                    F.col(PARTICION_MES).between(F.lit(d0.strftime("%Y-%m")), F.lit(d1.strftime("%Y-%m")))
                )
        # Distinct keys first: the map-side partial aggregate collapses a hot
        # (day, programme, agent) before the shuffle, and the join stays 1:1.
        hay = calls.select(*claves_llamada, *extra).distinct().withColumn("_con_llamada", F.lit(True))
        p = p.join(hay, claves_llamada + extra, "left").where(F.col("_con_llamada").isNull())
    return p.select(
        F.col("fecha"),
        F.col("hora_fin").alias("hora"),
        F.lit(PLACEHOLDER_CALLER).alias("llamante"),
        F.lit(0).alias("dur"),
        F.lit(None).cast("string").alias("station"),
        F.lit(None).cast("string").alias("voice_file"),
        F.col("log_name"),
        F.lit(PLACEHOLDER_RESULT).alias("resultado"),
        F.col("programa_id"),
    )


def asistencia_dia(
    spark: SparkSession,
    agentes: DataFrame,
    programas: DataFrame,
    fecha: dt.date | str,
    programa_id: object,
    log_names: Iterable[object],
    calls: DataFrame | None = None,
    en_cualquier_programa: bool = False,
) -> DataFrame:
    """The reference's form: one day, one programme, agents chosen by name."""
    if isinstance(fecha, str):
        fecha = dt.date.fromisoformat(fecha)
    names = list(log_names)
    name_type = agentes.schema["log_name"].dataType.simpleString()
    prog_type = programas.schema["id"].dataType.simpleString()
    presencias = spark.createDataFrame(
        [(fecha, programa_id, n) for n in names],
        f"fecha date, programa_id {prog_type}, log_name {name_type}",
    )
    return asistencia(
        calls, agentes, programas, presencias, ventana=(fecha, fecha), en_cualquier_programa=en_cualquier_programa
    )
