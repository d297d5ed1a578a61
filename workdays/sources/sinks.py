"""Sinks (K1, K3-K6): delimited month files, appends with a row count, quarantine per file.

All writes go through Spark's file commit protocol: a failed or killed job
publishes nothing (K6), and retried tasks never duplicate files. What a write replaces is
declared by the slices that were read, not only by the rows that are left, so a slice that
became empty is replaced too (K4).
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..model import EXPORT_NAME_STEM, LOAD_NAME_END
from ..session import borrar_carpeta

# Partition value that Spark writes for a NULL or empty string.
SIN_VALOR = "__HIVE_DEFAULT_PARTITION__"
# Rows of one published month file; a larger slice is a folder of that name with several files.
FILAS_POR_ARCHIVO = 5_000_000


def _escritor_csv(df: DataFrame, sep: str, encoding: str):
    """Writer of the load-file layout: values as they are, spaces stay, a quote inside a quoted value is doubled."""
    return (
        df.write.option("header", "true")
        .option("sep", sep)
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("escape", '"')
        .option("emptyValue", "")
    )


def _sistema(spark: SparkSession, ruta: str):
    """(Hadoop file system, path) of a folder or file in whatever store it is."""
    camino = spark._jvm.org.apache.hadoop.fs.Path(ruta)
    return camino.getFileSystem(spark._jsc.hadoopConfiguration()), camino


def _valores(camino: str, particiones: Sequence[str]) -> tuple:
    """Partition values in a folder path, as text; None for NULL or empty."""
    partes = dict(p.split("=", 1) for p in camino.split("/")[-len(particiones) :])
    return tuple(None if partes[c] == SIN_VALOR else unquote(partes[c]) for c in particiones)


def tramos_guardados(spark: SparkSession, ruta: str, particiones: Sequence[str]) -> dict[tuple, tuple[str, set[str]]]:
    """Slices stored under ``ruta``: partition values -> (folder, its files). One listing by the driver."""
    fs, _ = _sistema(spark, ruta)
    patron = "/".join([ruta.rstrip("/"), *(f"{c}=*" for c in particiones), "[!._]*"])
    hallados: dict[tuple, tuple[str, set[str]]] = {}
    for estado in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(patron)) or []:
        carpeta, nombre = estado.getPath().getParent().toString(), estado.getPath().getName()
        hallados.setdefault(_valores(carpeta, particiones), (carpeta, set()))[1].add(nombre)
    return hallados


def _carpetas_escritas(spark: SparkSession, ruta: str, particiones: Sequence[str]) -> dict[tuple, tuple[str, str | None]]:
    """Slices under ``ruta``: partition values -> (folder, its file if it has only one). The driver holds a line a slice, whatever
    the number of files."""
    fs, _ = _sistema(spark, ruta)
    camino = spark._jvm.org.apache.hadoop.fs.Path
    halladas: dict[tuple, tuple[str, str | None]] = {}
    for estado in fs.globStatus(camino("/".join([ruta.rstrip("/"), *(f"{c}=*" for c in particiones)]))) or []:
        carpeta = estado.getPath().toString()
        archivos = fs.globStatus(camino(f"{carpeta}/[!._]*"))
        if len(archivos):
            halladas[_valores(carpeta, particiones)] = carpeta, archivos[0].getPath().toString() if len(archivos) == 1 else None
    return halladas


def _declarados(spark: SparkSession, guardados: list[tuple], tramos: DataFrame, particiones: Sequence[str]) -> set[tuple]:
    """Which of the stored slices are among ``tramos``: a join, so ``tramos`` may be of any size."""
    if not guardados:
        return set()
    esquema = ", ".join(f"`{c}` string" for c in particiones)
    hay = spark.createDataFrame(guardados, esquema).alias("h")
    texto = tramos.select(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in particiones]).distinct().alias("t")
    igual = F.lit(True)
    for c in particiones:
        igual = igual & F.col(f"h.{c}").eqNullSafe(F.col(f"t.{c}"))
    return {tuple(r) for r in hay.join(texto, igual, "left_semi").collect()}


def _vaciar(spark: SparkSession, antes: dict, declarados: set[tuple]) -> None:
    """Remove the declared slices that the write left as they were: they have no rows any more."""
    for valores in declarados:
        carpeta, archivos = antes[valores]
        fs, camino = _sistema(spark, carpeta)
        if fs.exists(camino) and archivos & {e.getPath().getName() for e in fs.listStatus(camino)}:
            fs.delete(camino, True)


def _con_tramos(spark: SparkSession, ruta: str, particiones: Sequence[str], tramos: DataFrame | None, escribir: Callable) -> None:
    """Run a dynamic partition overwrite of ``ruta``, then empty the declared slices that it left."""
    antes = tramos_guardados(spark, ruta, particiones) if tramos is not None else {}
    declarados = _declarados(spark, list(antes), tramos, particiones) if antes else set()
    escribir()
    _vaciar(spark, antes, declarados)


def reemplazar_tramos(df: DataFrame, ruta: str, particiones: Sequence[str], tramos: DataFrame | None = None) -> int:
    """K4 for Parquet tables: the slices of ``df`` and the declared ones (``tramos``) hold the rows of
    ``df`` afterwards; others stay. ``df`` must not read ``ruta``. Returns the rows written."""
    obs = Observation("reemplazadas")
    df = df.hint("rebalance", *particiones)
    escritor = df.observe(obs, F.count(F.lit(1)).alias("filas")).write.mode("overwrite")
    escritor = escritor.option("partitionOverwriteMode", "dynamic").partitionBy(*particiones)
    _con_tramos(df.sparkSession, ruta, particiones, tramos, lambda: escritor.parquet(ruta))
    return int(obs.get["filas"])


def escribir_delimitado(
    df: DataFrame,
    ruta: str,
    particiones: Sequence[str] = ("programa_id", "anio_mes"),
    sep: str = ";",
    encoding: str = "UTF-8",
    tramos: DataFrame | None = None,
) -> int:
    """K1 + K4: ``;``-separated files with a header, one folder per programme and month.

    Partitions present in ``df`` replace their earlier files; all others are left untouched
    (dynamic partition overwrite), unless ``tramos`` (a frame with the partition columns, e.g. of
    the files that were read) declares them: a declared slice without rows is emptied, after
    the new rows are published. Returns the rows written.
    """
    obs = Observation("escritas")
    escritor = _escritor_csv(df.observe(obs, F.count(F.lit(1)).alias("filas")), sep, encoding)
    escritor = escritor.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*particiones)
    _con_tramos(df.sparkSession, ruta, particiones, tramos, lambda: escritor.csv(ruta))
    return int(obs.get["filas"])


def nombre_de_carga(anio_mes: str, salida: str | None) -> str:
    """S5's name of a month's load file: ``YYYYMM [SALIDA ]to_access.csv``."""
    return f"{anio_mes} {salida + ' ' if salida else ''}{LOAD_NAME_END}"


def nombre_de_exportacion(dia: str, salida: str | None) -> str:
    """S1's name of a day's export: ``YYYYMMDD [SALIDA ]multioption_monitor_*``."""
    return f"{dia} {salida + ' ' if salida else ''}{EXPORT_NAME_STEM}{dia}.csv"


def publicar(
    df: DataFrame,
    directorio: str,
    clave: str = "anio_mes",
    nombrar: Callable[[str, str | None], str] = nombre_de_carga,
    tramos: DataFrame | None = None,
    orden: Sequence[str] = (),
    sep: str = ";",
    encoding: str = "UTF-8",
    filas_por_archivo: int = FILAS_POR_ARCHIVO,
    presentar: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """K1 under the names that S5 (and S1) look for: a file for each ``salida`` and ``clave``.

    ``df`` has ``salida`` and the date key (``files.carga_mensual``); columns of ``orden`` sort the rows of
    a file and are not written. The slices are first written to a hidden folder beside their
    place; when that job has committed, each is given its name by the file system, replacing the
    earlier file, and declared slices (``tramos``) without rows lose theirs. A failing job publishes
    nothing. A slice of more than ``filas_por_archivo`` rows is cut by the hash of its rows and
    becomes a folder of that name, which is read like a file, so no task writes more.

    A slice that one task reads whole is written by that task; the rows of the others are shuffled once.
    ``presentar`` makes the written columns after that, row by row (``salida`` and the key pass through it
    as they are), so that only what it needs is shuffled and sorted. Returns the rows written.
    """
    spark, claves = df.sparkSession, ["salida", clave]
    base = directorio.rstrip("/")
    previo = f"{base}/_publicar-{uuid.uuid4().hex}"
    quedan, van = _en_su_tarea(df, claves, filas_por_archivo)

    def escribir(repartido: DataFrame) -> int:
        obs = Observation("publicadas")
        en_orden = _sin_nulos(repartido, claves).sortWithinPartitions(*claves, *orden)
        escrito = (presentar(en_orden) if presentar else en_orden).drop(*orden)
        escritor = _escritor_csv(escrito.observe(obs, F.count(F.lit(1)).alias("filas")), sep, encoding).mode("append")
        # nothing reads the hidden folder before its jobs have ended, so tasks may put their files into it themselves;
        # else the driver would move each of them, one after the other
        escritor = escritor.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        escritor.option("maxRecordsPerFile", filas_por_archivo).partitionBy(*claves).csv(previo)
        return int(obs.get["filas"])

    camino = spark._jvm.org.apache.hadoop.fs.Path
    filas = 0
    try:
        if quedan:
            filas = escribir(_de_tramos(df, quedan, claves).drop("_archivos") if van else df)
            # rows that came to other tasks than those they were counted in: their slices are dealt after all
            escritos = _carpetas_escritas(spark, previo, claves)
            partidos = [r for r in quedan if escritos.get(_como_carpeta(r, claves), ("", ""))[1] is None]
            for valores in {_como_carpeta(r, claves) for r in partidos}:
                borrar_carpeta(spark, escritos[valores][0])
            filas -= sum(r["_filas"] for r in partidos)
            van = van + partidos
        if van or not quedan:
            parte = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("_archivos"))
            con_parte = _de_tramos(df, van, claves).withColumn("_parte", parte).drop("_archivos")
            filas += escribir(con_parte.repartition(*claves, "_parte").drop("_parte"))
        nuevos = _carpetas_escritas(spark, previo, claves)
        fs, _ = _sistema(spark, base)
        nombres = {}
        for (salida, k), (carpeta, archivo) in sorted(nuevos.items(), key=str):
            nombre = nombrar(k, salida)
            nombres[nombre] = None
            destino = camino(f"{base}/{nombre}")
            origen = camino(archivo or carpeta)
            fs.delete(destino, True)
            if not fs.rename(origen, destino):
                raise OSError(f"could not publish {destino}")
        if tramos is not None:
            # declared slices: those whose name is there and was not just written
            hay = [e.getPath().getName() for e in fs.globStatus(camino(f"{base}/[!._]*")) or []]
            for salida, k in _con_nombre(spark, [n for n in hay if n not in nombres], tramos, clave, nombrar):
                fs.delete(camino(f"{base}/{nombrar(k, salida)}"), True)
    finally:
        borrar_carpeta(spark, previo)
    return filas


def _sin_nulos(df: DataFrame, particiones: Sequence[str]) -> DataFrame:
    """Text partition columns with '' for NULL, which go to the same folder: the writer then takes rows in their order as they
    are, where it would turn '' into NULL and sort them once more."""
    textos = [c for c in particiones if df.schema[c].dataType == StringType()]
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in textos})


def _en_su_tarea(df: DataFrame, claves: Sequence[str], filas_por_archivo: int) -> tuple[list[Row], list[Row]]:
    """The slices of ``df``, a line each: those that the tasks which read them may write, and those whose rows are dealt.

    A slice may stay if one task reads all its rows, they fit a file, and that task has no more rows to write
    than twice its share: what only a few tasks read is dealt to all of them. Both kinds take a job each, so all
    are dealt if less than half of the rows could stay.
    """
    tarea, n = F.col("_tarea"), F.count(F.lit(1))
    por_tramo = df.select(*claves, F.spark_partition_id().alias("_tarea")).groupBy(*claves)
    archivos = F.ceil(n / filas_por_archivo).alias("_archivos")
    tramos = por_tramo.agg(n.alias("_filas"), archivos, F.min(tarea).alias("_de"), F.max(tarea).alias("_a")).collect()
    carga = Counter()
    for r in tramos:
        carga[r["_de"]] += r["_filas"] if r["_de"] == r["_a"] else 0
    todas = sum(r["_filas"] for r in tramos)
    parte = 2 * todas / df.sparkSession.sparkContext.defaultParallelism
    quedan, van = [], []
    for r in tramos:
        (quedan if r["_de"] == r["_a"] and r["_archivos"] == 1 and carga[r["_de"]] <= parte else van).append(r)
    return (quedan, van) if 2 * sum(r["_filas"] for r in quedan) >= todas else ([], tramos)


def _de_tramos(df: DataFrame, tramos: list[Row], claves: Sequence[str]) -> DataFrame:
    """The rows of ``df`` in these slices, with the number of files (``_archivos``) of theirs. The slices, a line each, are
    sent to the rows, which stay where they are."""
    esquema = StructType([*[df.schema[c] for c in claves], StructField("_archivos", LongType())])
    t = df.sparkSession.createDataFrame([(*[r[c] for c in claves], r["_archivos"]) for r in tramos], esquema).alias("t")
    igual = F.lit(True)
    for c in claves:
        igual = igual & F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}"))
    return df.alias("d").join(F.broadcast(t), igual).select(*[F.col(f"d.`{c}`") for c in df.columns], "_archivos")


def _como_carpeta(fila: Row, claves: Sequence[str]) -> tuple:
    """A slice's values as its folder tells them: text, None for NULL or empty."""
    return tuple(None if fila[c] in (None, "") else str(fila[c]) for c in claves)


def _con_nombre(spark: SparkSession, nombres: list[str], tramos: DataFrame, clave: str, nombrar: Callable) -> list[tuple]:
    """The declared slices whose file name is among ``nombres``: no more come back than there are files."""
    if not nombres:
        return []
    # a slice's output name and key stand in its file's name, so the join needs no name rule
    hay = spark.createDataFrame([(n,) for n in nombres], "_archivo string")
    t = tramos.select(F.nullif(F.col("salida").cast("string"), F.lit("")).alias("salida"), F.col(clave).cast("string").alias(clave)).distinct()
    cabe = F.startswith(F.col("_archivo"), F.concat(F.col(clave), F.lit(" "), F.coalesce("salida", F.lit(""))))
    pares = t.join(hay, (F.col(clave) == F.substring_index("_archivo", " ", 1)) & cabe, "left_semi").collect()
    return [(s, k) for s, k in pares if nombrar(k, s) in nombres]


def anexar(
    df: DataFrame,
    ruta: str,
    particiones: Sequence[str] = (),
    formato: str = "parquet",
) -> int:
    """K3 + K5: append ``df`` and return how many rows were written, counted inside the write job."""
    obs = Observation("anexadas")
    if particiones:  # each slice's rows meet: a file or a few of them a slice, not one for each task that had rows of it
        df = df.hint("rebalance", *particiones)
    w = df.observe(obs, F.count(F.lit(1)).alias("filas")).write.mode("append").format(formato)
    if particiones:
        w = w.partitionBy(*particiones)
    w.save(ruta)
    return int(obs.get["filas"])


def reemplazar_por_archivo(df: DataFrame, ruta: str, leidos: DataFrame | None = None) -> int:
    """Quarantine sink: one folder per source file; a file that is loaded again replaces its own
    rows and leaves the others. Returns the rows written.

    A file is its whole path (column ``ruta``), whose hash names the folder (``origen``): equally
    named files of different folders are different files. Rows without ``ruta`` go by ``archivo``.
    ``leidos`` (same columns) declares the files that were read: one without rows in ``df`` has
    been corrected, and its earlier rows go.
    """
    tramos = leidos.select(_origen(leidos).alias("origen")) if leidos is not None else None
    return reemplazar_tramos(df.withColumn("origen", _origen(df)), ruta, ("origen",), tramos)


def _origen(df: DataFrame):
    nombre = F.coalesce(F.col("ruta"), F.col("archivo")) if "ruta" in df.columns else F.col("archivo")
    return F.sha2(nombre, 256)
