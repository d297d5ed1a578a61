"""Ingest (X3): delimited files -> normalised calls -> insert-ignore into the calls table.

The calls table is parquet partitioned by ``anio_mes``. A load reads only the
months present in the batch (static partition pruning), skips keys already
stored, keeps the first row per key inside the batch, and appends.
Running the same load twice adds nothing the second time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.normalize import normalizar
from ..model import CALLS, DEFAULT_KEY
from ..operators.filters import activos
from ..operators.load import insertar_ignorando
from ..session import borrar_carpeta, carpeta_de_trabajo
from ..sources.files import COLUMNAS
from ..sources.sinks import _sistema, anexar, reemplazar_por_archivo, tramos_guardados

PARTICION = "anio_mes"
# Place of a row among all files, in the order in which the first row of a key wins (D24): file
# name, then whole path (equal names in several folders), then place in the file.
LUGAR = ["archivo", "ruta", "bloque", "fila"]
# Stored calls table: the calls schema plus the month partition column.
TABLA = T.StructType(CALLS.fields + [T.StructField(PARTICION, T.StringType())])


@dataclass
class Resultado:
    insertadas: int
    cuarentena: int


def normalizado(
    crudo: DataFrame,
    programas: DataFrame | None = None,
    programa_id: int | None = None,
) -> DataFrame:
    """Normalise a ``leer_delimitado`` frame and tag each row with its programme.

    With ``programa_id`` every row gets it (the reference's form: the user
    picked the programme). Otherwise the file name's output part is matched to
    ``nombre_salida`` of the active programmes (NULL and '' are the same). A name
    that no active programme has ('programa') or that several have
    ('programa_ambiguo') is quarantined; no row is ever multiplied.
    Every row is kept; ``motivo`` is NULL for a good row, else the reasons.
    """
    df = normalizar(crudo)
    if programa_id is not None:
        df = df.withColumn("programa_id", F.lit(programa_id).cast("int")).withColumn("_n", F.lit(1))
    else:
        if programas is None:
            raise ValueError("programas or programa_id is needed to tag rows")
        prog = (
            activos(programas)
            .groupBy(F.coalesce(F.col("nombre_salida"), F.lit("")).alias("_salida"))
            .agg(F.min("id").cast("int").alias("programa_id"), F.count_distinct("id").alias("_n"))
            .withColumn("programa_id", F.when(F.col("_n") == 1, F.col("programa_id")))
        )
        df = df.withColumn("_salida", F.coalesce(F.col("salida"), F.lit(""))).join(prog, "_salida", "left").drop("_salida")
    motivo = F.concat_ws(
        ",",
        F.col("motivo_archivo"),
        F.col("motivo"),
        F.when(F.col("_n") > 1, F.lit("programa_ambiguo")).when(F.col("programa_id").isNull(), F.lit("programa")),
    )
    return df.withColumn("motivo", F.when(motivo != "", motivo)).drop("_n")


def buenas(df: DataFrame) -> DataFrame:
    """Good rows of a ``normalizado`` frame in the calls schema, plus ``LUGAR`` and ``anio_mes``."""
    return df.where(F.col("motivo").isNull()).select(
        *[F.col(f.name).cast(f.dataType) for f in CALLS.fields],
        "archivo",
        "ruta",
        "bloque",
        "fila",
        F.date_format("fecha", "yyyy-MM").alias(PARTICION),
    )


def malas(df: DataFrame) -> DataFrame:
    """Quarantined rows of a ``normalizado`` frame, with their ``motivo``."""
    return df.where(F.col("motivo").isNotNull())


def _sin_textos(df: DataFrame) -> DataFrame:
    """A ``normalizado`` frame whose good rows leave out the texts that were read into values: only quarantine keeps them."""
    return df.withColumns({c: F.when(F.col("motivo").isNotNull(), F.col(c)) for c in ("fecha_txt", "hora_txt", "dur_txt")})


def preparar(
    crudo: DataFrame,
    programas: DataFrame | None = None,
    programa_id: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of ``normalizado``; two filters over one plan."""
    df = normalizado(crudo, programas, programa_id)
    return buenas(df), malas(df)


def _tabla_o_vacia(spark: SparkSession, ruta: str) -> DataFrame:
    try:
        return spark.read.schema(TABLA).parquet(ruta)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], TABLA)
        raise


def nuevas(
    spark: SparkSession,
    destino: str,
    lote: DataFrame,
    key_cols: Sequence[str] = DEFAULT_KEY,
    meses: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``lote`` that an insert-ignore into the table at ``destino`` adds (K2).

    Inside the batch the first row wins: by ``LUGAR``, then (rows without a place) by every column. With ``meses`` (the batch's months) only those partitions
    of the table are read; that holds only where ``fecha`` is part of the key (a conflict then
    needs the same month), so for other keys it is ignored.
    """
    tabla = _tabla_o_vacia(spark, destino)
    if meses is not None and "fecha" in key_cols:
        tabla = tabla.where(F.col(PARTICION).isin(list(meses)))
    lugar = [c for c in LUGAR if c in lote.columns]
    orden = lugar + [c for c in lote.columns if c not in key_cols and c not in lugar]
    cols = [f.name for f in CALLS.fields] + [PARTICION]
    out = insertar_ignorando(tabla, lote, key_cols, order_cols=orden)
    return out.select(*cols)


def meses_de(lote: DataFrame) -> list[str]:
    """The batch's months: a calendar's handful."""
    return [r[0] for r in lote.select(PARTICION).distinct().collect() if r[0] is not None]


def cargar(
    spark: SparkSession,
    destino: str,
    lote: DataFrame,
    key_cols: Sequence[str] = DEFAULT_KEY,
    cuarentena: DataFrame | None = None,
    destino_cuarentena: str | None = None,
) -> Resultado:
    """Insert-ignore ``lote`` into the calls table and replace its files' quarantine (K2, K3, K5, K6).

    The batch is first written to a folder under the shared ``spark.checkpoint.dir``:
    the source files are parsed once, the copy survives the loss of executors,
    and its distinct months become a static partition filter, so the stored
    history outside those months is never read. The copy is deleted at the end.
    """
    copia = carpeta_de_trabajo(spark, "cargas")
    try:
        lote.write.parquet(copia)
        lote = spark.read.schema(lote.schema).parquet(copia)
        n = anexar(nuevas(spark, destino, lote, key_cols, meses_de(lote)), destino, particiones=[PARTICION])
        m = 0
        if cuarentena is not None and destino_cuarentena is not None:
            m = reemplazar_por_archivo(cuarentena, destino_cuarentena)
    finally:
        borrar_carpeta(spark, copia)
    return Resultado(n, m)


def _declarados(df: DataFrame, leidos: DataFrame | None) -> DataFrame:
    """Files that were read: those with a row, and those that the caller names."""
    con_filas = df.select("ruta", "archivo").distinct()
    return con_filas if leidos is None else con_filas.unionByName(leidos.select("ruta", "archivo"))


def ingerir(
    spark: SparkSession,
    destino: str,
    crudo: DataFrame,
    programas: DataFrame | None = None,
    programa_id: int | None = None,
    destino_cuarentena: str | None = None,
    key_cols: Sequence[str] = DEFAULT_KEY,
    leidos: DataFrame | None = None,
) -> Resultado:
    """X3 in one pass over the source: normalise, write one copy, then load and quarantine.

    The normalised batch (good and bad rows) is written once, under the shared
    ``spark.checkpoint.dir``; the insert-ignore load of the good rows and the
    quarantine both read that copy, so the source files are parsed once and a
    lost executor costs a re-read of the copy, not a re-parse. The table is
    appended first; a load that breaks off between the two is repeated safely:
    stored rows are skipped and a file's quarantine replaces itself. The files whose quarantine is
    replaced are those of ``leidos`` (``files.archivos``) and those with a row: a corrected file
    empties its own.
    """
    copia = carpeta_de_trabajo(spark, "cargas")
    try:
        df = _sin_textos(normalizado(crudo, programas, programa_id))
        df.write.parquet(copia)
        df = spark.read.schema(df.schema).parquet(copia)
        lote = buenas(df)
        n = anexar(nuevas(spark, destino, lote, key_cols, meses_de(lote)), destino, particiones=[PARTICION])
        m = 0
        if destino_cuarentena is not None:
            m = reemplazar_por_archivo(malas(df), destino_cuarentena, _declarados(df, leidos))
    finally:
        borrar_carpeta(spark, copia)
    return Resultado(n, m)


def reprocesar(
    spark: SparkSession,
    destino: str,
    destino_cuarentena: str,
    programas: DataFrame,
    key_cols: Sequence[str] = DEFAULT_KEY,
) -> Resultado:
    """X3 again for the quarantined rows, which are kept as text: after ``programas`` changed, what has
    become readable moves to the calls, once.

    The rows to move and what stays in quarantine are written under ``_reproceso`` of the
    quarantine first; renaming that folder is the one point of decision. Behind it every step may be
    repeated: each touched file's quarantine is replaced by what stays, and the moved rows' files are
    renamed into the calls table. A run that broke off is finished by the next one. ``cuarentena``
    of the result counts the rows that stay.
    """
    base = f"{destino_cuarentena.rstrip('/')}/_reproceso"
    fs, _ = _sistema(spark, base)
    camino = spark._jvm.org.apache.hadoop.fs.Path
    for estado in fs.globStatus(camino(f"{base}/*")) or []:
        if estado.getPath().getName().startswith("decidido-"):
            _aplicar(spark, estado.getPath().toString(), destino, destino_cuarentena)
        else:
            borrar_carpeta(spark, estado.getPath().toString())  # never decided
    try:
        guardadas = spark.read.parquet(destino_cuarentena)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return Resultado(0, 0)
    marca = uuid.uuid4().hex
    previo = f"{base}/{marca}"
    df = normalizado(guardadas.select(*COLUMNAS), programas)
    df.write.parquet(f"{previo}/todas")
    df = spark.read.schema(df.schema).parquet(f"{previo}/todas")
    lote = buenas(df)
    n = anexar(nuevas(spark, destino, lote, key_cols, meses_de(lote)), f"{previo}/buenas", particiones=[PARTICION])
    m = anexar(malas(df), f"{previo}/malas")
    decidido = f"{base}/decidido-{marca}"
    if not fs.rename(camino(previo), camino(decidido)):
        raise OSError(f"could not decide {decidido}")
    _aplicar(spark, decidido, destino, destino_cuarentena)
    return Resultado(n, m)


def _aplicar(spark: SparkSession, decidido: str, destino: str, destino_cuarentena: str) -> None:
    """Carry out a decided replay; may be repeated from any place."""
    camino = spark._jvm.org.apache.hadoop.fs.Path
    fs, _ = _sistema(spark, decidido)
    todas = spark.read.parquet(f"{decidido}/todas")
    esquema = todas.schema
    quedan = spark.read.schema(esquema).parquet(f"{decidido}/malas")
    reemplazar_por_archivo(quedan, destino_cuarentena, todas.select("ruta", "archivo").distinct())
    for (mes,), (carpeta, archivos) in tramos_guardados(spark, f"{decidido}/buenas", [PARTICION]).items():
        lugar = camino(f"{destino.rstrip('/')}/{carpeta.rsplit('/', 1)[1]}")
        fs.mkdirs(lugar)
        for nombre in sorted(archivos):  # a moved file is no longer here
            if not fs.rename(camino(f"{carpeta}/{nombre}"), camino(f"{lugar.toString()}/{nombre}")):
                raise OSError(f"could not move {nombre} to month {mes}")
    borrar_carpeta(spark, decidido)
