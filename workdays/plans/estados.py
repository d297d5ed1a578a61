"""Reports from a maintained roll-up: small states per load, merged, in place of the calls.

A state is one row for each (programme, agent, month): the days as a set of bits, the seconds, the
calls with a duration and all calls. States merge (``bit_or`` and sums), so each load appends the
states of the rows that it inserted, and a report reads the states of its months only.

Exactly once: before the calls are appended, the load notes its months under ``pendientes``; the
note goes when the states are stored. A note that is still there belongs to a load that broke off
in between, and the states of its months are built anew from the calls before they are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.present import seg_a_hora
from ..model import DEFAULT_KEY, PLACEHOLDER_CALLER, Period
from ..operators.filters import aplicar_reglas, de_programa, en_periodo
from ..session import borrar_carpeta, carpeta_de_trabajo
from ..sources.sinks import anexar, reemplazar_tramos
from . import reports
from .ingest import PARTICION, TABLA, meses_de, nuevas

CLAVES = ["programa_id", "log_name", "anio", "mes", "marcador"]
MEDIDAS = ["mapa", "tot_sec", "n_dur", "num_llamadas"]
ESQUEMA = (
    "programa_id int, log_name string, anio int, mes int, marcador boolean, mapa bigint, tot_sec bigint, n_dur bigint, "
    f"num_llamadas bigint, {PARTICION} string"
)


def estados_de(calls: DataFrame) -> DataFrame:
    """States of a set of calls; attendance placeholders have their own (``marcador``, D18)."""
    marcador = (F.col("dur") == 0) & (F.col("llamante") == PLACEHOLDER_CALLER)
    grupo = ["programa_id", "log_name", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"), marcador.alias("marcador")]
    estados = calls.groupBy(*grupo).agg(
        reports.mapa_de_dias().alias("mapa"),
        F.sum("dur").cast("bigint").alias("tot_sec"),
        F.count("dur").alias("n_dur"),
        F.count(F.lit(1)).alias("num_llamadas"),
    )
    return estados.withColumn(PARTICION, F.date_format(F.make_date("anio", "mes", F.lit(1)), "yyyy-MM"))


def fundir(estados: DataFrame, claves: Sequence[str] = (*CLAVES, PARTICION)) -> DataFrame:
    """One state for each key: states of several loads, or of finer keys, merged."""
    return estados.groupBy(*claves).agg(
        F.bit_or("mapa").alias("mapa"), *[F.sum(c).cast("bigint").alias(c) for c in MEDIDAS[1:]]
    )


def _leer(spark: SparkSession, ruta: str, esquema) -> DataFrame:
    try:
        return spark.read.schema(esquema).parquet(ruta)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], esquema)


def cargar(
    spark: SparkSession,
    destino: str,
    estados: str,
    lote: DataFrame,
    key_cols: Sequence[str] = DEFAULT_KEY,
) -> int:
    """Insert-ignore ``lote`` (``ingest.buenas``) into the calls at ``destino`` and keep the states at ``estados`` up to date.

    The new rows are written once under the shared checkpoint folder; the calls and the
    states are both appended from that copy. Returns the rows inserted.
    """
    reparar(spark, destino, estados)
    copia = carpeta_de_trabajo(spark, "estados")
    nota = f"{estados}/pendientes/{uuid.uuid4().hex}"
    try:
        # of the stored calls only the batch's months are read and dealt, however long the history is
        meses = meses_de(lote) if "fecha" in key_cols else None
        nuevas(spark, destino, lote, key_cols, meses).write.parquet(copia)
        filas = spark.read.schema(TABLA).parquet(copia)
        filas.select(PARTICION).distinct().coalesce(1).write.parquet(nota)
        n = anexar(filas, destino, particiones=[PARTICION])
        anexar(estados_de(filas), f"{estados}/datos", particiones=[PARTICION])
        borrar_carpeta(spark, nota)
    finally:
        borrar_carpeta(spark, copia)
    return n


def reparar(spark: SparkSession, destino: str, estados: str) -> int:
    """Build the states of the months that a broken-off load left in doubt; returns their number."""
    notas = _leer(spark, f"{estados}/pendientes/*", f"{PARTICION} string")
    meses = [r[0] for r in notas.distinct().collect()]  # a calendar's handful
    if meses:
        reconstruir(spark, destino, estados, meses)
    borrar_carpeta(spark, f"{estados}/pendientes")
    return len(meses)


def reconstruir(spark: SparkSession, destino: str, estados: str, meses: Sequence[str | None]) -> None:
    """Replace the states of some months by those of the stored calls."""
    tramos = spark.createDataFrame([(m,) for m in meses], f"{PARTICION} string")
    # a filter on the partition column, not a join: the other months' files are not opened
    suyos = F.col(PARTICION).isin([m for m in meses if m is not None])
    calls = _leer(spark, destino, TABLA).where(suyos | F.col(PARTICION).isNull() if None in meses else suyos)
    reemplazar_tramos(estados_de(calls), f"{estados}/datos", [PARTICION], tramos)


def compactar(spark: SparkSession, estados: str) -> int:
    """Merge the states of all loads into one row a key; returns the rows left."""
    copia = carpeta_de_trabajo(spark, "estados")
    try:
        fundir(_leer(spark, f"{estados}/datos", ESQUEMA)).write.parquet(copia)
        fundidos = spark.read.parquet(copia).select(*CLAVES, *MEDIDAS, PARTICION)
        return reemplazar_tramos(fundidos, f"{estados}/datos", [PARTICION])
    finally:
        borrar_carpeta(spark, copia)


def leer(spark: SparkSession, destino: str, estados: str) -> DataFrame:
    """States of all loads of the calls at ``destino``; what a broken-off load left is built first."""
    reparar(spark, destino, estados)
    return _leer(spark, f"{estados}/datos", ESQUEMA)


def _filtrar(estados, period, programa, reglas, excluir_marcadores, colacion) -> DataFrame:
    """The filters of the reports on states: a state has one programme, agent and month, as rules have."""
    df = estados.withColumn("fecha", F.make_date("anio", "mes", F.lit(1)))
    df = reports.con_colacion(de_programa(en_periodo(df, period), programa), colacion)
    if excluir_marcadores:
        df = df.where(~F.col("marcador"))
    return aplicar_reglas(df, reports.con_colacion(reglas, colacion))


def dias_por_agente(
    estados: DataFrame,
    period: Period | None = None,
    programa: object | None = None,
    reglas: DataFrame | None = None,
    excluir_marcadores: bool = False,
    colacion: str | None = None,
    por_programa: bool = True,
) -> DataFrame:
    """R1 (R5) from states: same columns and rows as ``reports.dias_por_agente`` of the calls."""
    df = _filtrar(estados, period, programa, reglas, excluir_marcadores, colacion)
    claves = (["programa_id"] if por_programa else []) + ["anio", "mes", "log_name"]
    return fundir(df, claves).select(*claves, reports.dias_en_mapa().alias("n_dias"))


def informes_dias(
    estados: DataFrame,
    agentes: DataFrame,
    grupos: DataFrame,
    programas: DataFrame,
    period: Period | None = None,
    programa: object | None = None,
    reglas: DataFrame | None = None,
    excluir_marcadores: bool = False,
    ordenar: bool = False,
    colacion: str | None = None,
    total: str = "tramo",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """R1, R2 and R3 from states: same rows as ``reports.informes_dias`` of the calls."""
    r1 = dias_por_agente(estados, period, programa, reglas, excluir_marcadores, colacion)
    agentes = reports.con_colacion(agentes, colacion)
    resto = (grupos, programas, period, programa, ordenar, total)
    return r1, reports._r2(r1, agentes, *resto), reports._r3(r1, agentes, *resto)


def media_por_agente(
    estados: DataFrame,
    period: Period | None = None,
    programa: object | None = None,
    mensual: bool = False,
    excluir_marcadores: bool = False,
    colacion: str | None = None,
    por_programa: bool = True,
) -> DataFrame:
    """R4 from states: same rows as ``reports.media_por_agente`` of the calls."""
    df = _filtrar(estados, period, programa, None, excluir_marcadores, colacion)
    claves = (["programa_id"] if por_programa else []) + (["anio", "mes"] if mensual else []) + ["log_name"]
    media = F.when(F.col("n_dur") > 0, F.expr("tot_sec div n_dur"))
    return fundir(df, claves).select(
        *claves, seg_a_hora(media).alias("dur_media"), media.alias("media_seg"), "tot_sec", "num_llamadas"
    )
