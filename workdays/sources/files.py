"""Delimited call exports and monthly load files.

Files of one read may have different headers: a ``CC`` column anywhere, a
missing trailing column, a corrupt first header. A single Spark CSV read
with one schema would shift such columns silently. Instead files are read as
lines, every line is split by position (all text, no inference; as many fields
as the widest header has; the CSV parser only where the line has a quote), and each data row is aligned by name through its
file's header (a join on the file path against one header row per file).
The first column that is not ``CC`` is the call day, whatever its header says.
An empty field is ``''``, as the loader of the monthly files reads it; NULL
stands only for a column that the file does not have. Rows carry their place
(``bloque``, ``fila``), so "the first row wins" follows the file.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..model import (
    EXPORT_NAME_STEM,
    HEADER_CALL_TIME,
    HEADER_CALLER,
    HEADER_LENGTH,
    HEADER_LOGIN,
    HEADER_RESULT,
    HEADER_STATION,
    HEADER_VOICE_FILE,
    LOAD_NAME_END,
    Period,
)
from ..session import borrar_carpeta, carpeta_de_trabajo, ensure_checkpoint_dir

# Text columns produced by the reader, keyed by the header name they come from.
CAMPOS = {
    "hora_txt": HEADER_CALL_TIME,
    "llamante": HEADER_CALLER,
    "dur_txt": HEADER_LENGTH,
    "station": HEADER_STATION,
    "voice_file": HEADER_VOICE_FILE,
    "log_name": HEADER_LOGIN,
    "resultado": HEADER_RESULT,
}
COLUMNAS = ["fecha_txt", *CAMPOS, "archivo", "salida", "clave_archivo", "motivo_archivo", "ruta", "bloque", "fila"]
# Optional column of the exports, dropped wherever it stands.
OPTIONAL_COLUMN = "CC"

# File-name layouts (stems in model.py): "YYYYMM [SALIDA ]<load end>" and
# "YYYYMMDD [SALIDA ]<export stem><time>.<ext>"; group 1 the date key, group 2 the output name.
CARGA_RE = rf"^([0-9]{{6}}) (?:(.+) )?{re.escape(LOAD_NAME_END)}$"
EXPORT_RE = rf"^([0-9]{{8}}) (?:(.+) )?{re.escape(EXPORT_NAME_STEM)}.*$"

_GLOB_SPECIAL = re.compile(r"([\\\[\]{}*?])")


def escapar_glob(texto: str) -> str:
    """Escape Hadoop glob characters in a literal name part."""
    return _GLOB_SPECIAL.sub(r"\\\1", texto)


def patron_cargas(directorio: str, salida: str = "") -> str:
    """Every month's load file of one output name: ``?????? [SALIDA ]to_access.csv``."""
    s = f"{escapar_glob(salida)} " if salida else ""
    return f"{directorio.rstrip('/')}/?????? {s}{LOAD_NAME_END}"


def patron_exportaciones(directorio: str, period: Period, salida: str = "", ext: str = "*") -> str:
    """The daily exports of one month and output name."""
    s = f"{escapar_glob(salida)} " if salida else ""
    return f"{directorio.rstrip('/')}/{period.year:04d}{period.month:02d}?? {s}{EXPORT_NAME_STEM}*.{ext}"


# Partition value Spark writes for a NULL or empty string.
_SIN_VALOR = "__HIVE_DEFAULT_PARTITION__"


def _decodificar(c: Column) -> Column:
    """Percent-decoding that keeps a literal ``+`` (``url_decode`` alone reads it as a space)."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def nombre_archivo() -> Column:
    """The file name of each row, decoded (``%20`` -> space; a literal ``+`` stays ``+``)."""
    return _decodificar(F.col("_metadata.file_name"))


def _vacio(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} {'bigint' if c in ('bloque', 'fila') else 'string'}" for c in COLUMNAS))


def archivos(spark: SparkSession, rutas: str | list[str], patron_nombre: str = CARGA_RE) -> DataFrame:
    """The matched files, also those without a line: ``ruta``, ``archivo``, ``salida``, ``clave_archivo``, ``anio_mes``.

    What a read declares as read (K4). Names only: Spark's own listing, which the driver holds
    for any read of the files; none is opened.
    """
    halladas: set[str] = set()
    for ruta in [rutas] if isinstance(rutas, str) else rutas:
        try:
            halladas.update(spark.read.format("binaryFile").load(ruta).inputFiles())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    # written as ``_metadata.file_path`` writes them: no empty authority
    rutas_uri = sorted(re.sub("^([a-z0-9]+):///", r"\1:/", x) for x in halladas)
    todas = spark.createDataFrame([(x,) for x in rutas_uri], "ruta string")
    con_nombre = todas.select("ruta", *_procedencia(F.col("ruta"), patron_nombre))
    return con_nombre.withColumn("anio_mes", F.substring("clave_archivo", 1, 6))


def esquema_posicional(ancho: int) -> str:
    """All-text positional schema ``_c0 .. _c{ancho-1}``."""
    return ", ".join(f"_c{i} string" for i in range(ancho))


# Never part of a line: a line is read as one field.
_SIN_SEPARADOR = "\x01\x02\x01"
OPCIONES_LINEA = {"sep": _SIN_SEPARADOR, "quote": "\x00", "escape": "\x00", "header": "false", "mode": "PERMISSIVE"}


def leer_lineas(spark: SparkSession, rutas: str | list[str], encoding: str = "UTF-8") -> DataFrame | None:
    """Every line (``_linea``) of the matched files with its file and place; None if no pattern matches.

    Each pattern of a list is resolved on its own, so one without files takes nothing away.
    """

    def leer(ruta: str) -> DataFrame:
        if encoding.upper().replace("-", "") != "UTF8":
            return spark.read.schema("_linea string").options(**OPCIONES_LINEA).option("encoding", encoding).csv(ruta)
        # the same lines without a parser for each file; blank ones (nothing above a space) are left out, as there
        texto = spark.read.text(ruta).where((F.col("value") >= "!") | F.col("value").rlike(r"[^\x00-\x20]"))
        return texto.select(F.make_valid_utf8("value").alias("_linea"), "_metadata")

    return _cada_patron(rutas, leer)


def _cada_patron(rutas: str | list[str], leer: Callable[[str], DataFrame]) -> DataFrame | None:
    """The rows of all patterns that match a file, with their file and place; None if none does."""
    todas = None
    for ruta in [rutas] if isinstance(rutas, str) else rutas:
        try:
            una = con_origen(leer(ruta))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        todas = una if todas is None else todas.unionAll(una)
    # in scan order: ascending inside each block of a file
    return todas.withColumn("_fila", F.monotonically_increasing_id()) if todas is not None else None


def ancho_de_cabeceras(lineas: DataFrame, sep: str = ";") -> int:
    """Fields of the widest header (quoted separators counted in, so never too few).

    A file's header is its first line with a field of that name; other lines don't count.
    One number comes back; fields beyond a file's own header have no name and are ignored.
    """
    s = re.escape(sep)
    es_campo = F.col("_linea").rlike(f'(?:^|{s})"?{re.escape(HEADER_CALL_TIME)}"?(?:{s}|$)')
    ancho = F.min_by(F.size(F.split("_linea", s, -1)), F.struct("_bloque", "_fila")).alias("_ancho")
    cabeceras = lineas.where(F.col("_linea").contains(HEADER_CALL_TIME) & es_campo).groupBy("_ruta").agg(ancho)
    return cabeceras.agg(F.max("_ancho")).first()[0] or 1


def posibles_cabeceras(lineas: DataFrame, tareas: int | None = None) -> DataFrame:
    """The lines that hold the name of a header field, stored once: the width and the header table are
    both taken from them, so the files are opened once for their headers and once for their rows.
    With ``tareas`` they are read by so many tasks, for lines in many small blocks."""
    ensure_checkpoint_dir(lineas.sparkSession)
    posibles = lineas.where(F.col("_linea").contains(HEADER_CALL_TIME))
    return (posibles.repartition("_ruta") if tareas is None else posibles.coalesce(tareas)).checkpoint(eager=True)


def partir(lineas: DataFrame, ancho: int, sep: str = ";") -> DataFrame:
    """Split lines into their first ``ancho`` fields, ``_cs``: a quoted field may hold the separator, ``""`` is a quote.

    An empty field is ``''`` or NULL, a missing one is NULL or not there. ``_comilla``: a quoted
    field is not closed on its line (its value went on after a line break).
    """
    linea = F.col("_linea")
    abierta = _abierta(linea, sep)
    if "_rota" in lineas.columns:
        abierta = abierta | F.col("_rota")
    # a line without a quote (or a NUL, which the parser takes for its own) is cut at the separators: the parser takes
    # several times as long for the same fields
    llana = ~linea.contains('"') & ~linea.contains("\x00") if len(sep) == 1 else F.lit(False)
    cortada = F.when(llana, F.slice(F.split(linea, re.escape(sep), ancho + 1), 1, ancho))
    lugar = ["_ruta", "_bloque", "_fila", linea.contains(HEADER_CALL_TIME).alias("_posible"), abierta.alias("_comilla")]
    partidas = lineas.select(*lugar, cortada.alias("_cortada"), F.when(~llana, linea).alias("_otra"))
    leida = F.from_csv("_otra", esquema_posicional(ancho), {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    # a generator, so that a line is parsed once whatever is done with its fields
    partidas = partidas.select("_ruta", "_bloque", "_fila", "_posible", "_comilla", "_cortada", F.explode(F.array(leida)).alias("_leida"))
    campos = F.coalesce("_cortada", F.array(*[F.col(f"_leida._c{i}") for i in range(ancho)]))
    return partidas.select("_ruta", "_bloque", "_fila", "_posible", "_comilla", campos.alias("_cs"))


def con_origen(raw: DataFrame) -> DataFrame:
    """Add each row's file path (S8; names are decoded once per file in ``alinear``) and block."""
    cols = [c for c in raw.columns if c != "_metadata"]
    return raw.select(*cols, F.col("_metadata.file_path").alias("_ruta"), F.col("_metadata.file_block_start").alias("_bloque"))


def _nombre_de_ruta(ruta: Column) -> Column:
    """Decoded file name (last path segment) of a file path URI."""
    return _decodificar(F.element_at(F.split(ruta, "/"), -1))


def _procedencia(ruta: Column, patron_nombre: str) -> list[Column]:
    """archivo, salida, clave_archivo of a file: from its name (or its folder's, where a published
    month is a folder of that name), or else from the folders a partitioned write made
    (salida=<name>/anio_mes=<YYYYMM>/part-...)."""
    propio, carpeta = _nombre_de_ruta(ruta), _decodificar(F.try_element_at(F.split(ruta, "/"), F.lit(-2)))
    archivo = F.when(~propio.rlike(patron_nombre) & carpeta.rlike(patron_nombre), carpeta).otherwise(propio)
    decod = _decodificar(_decodificar(ruta))
    ok = archivo.rlike(patron_nombre)
    salida_carpeta = F.regexp_extract(decod, r"/salida=([^/]*)/", 1)
    salida_carpeta = F.when(salida_carpeta != _SIN_VALOR, salida_carpeta)
    return [
        archivo.alias("archivo"),
        F.nullif(
            F.when(ok, F.regexp_extract(archivo, patron_nombre, 2)).otherwise(salida_carpeta), F.lit("")
        ).alias("salida"),
        F.nullif(
            F.when(ok, F.regexp_extract(archivo, patron_nombre, 1)).otherwise(
                F.regexp_extract(decod, r"/anio_mes=([0-9]{6})/", 1)
            ),
            F.lit(""),
        ).alias("clave_archivo"),
    ]


def alinear(
    partidas: DataFrame, patron_nombre: str = CARGA_RE, cabeceras: DataFrame | None = None, difundir: bool = False
) -> DataFrame:
    """Align positional rows (``partir``) by their file's header (the core of ``leer_delimitado``).

    Works on a batch read and on one streaming micro-batch alike: a file's rows
    and its header line always arrive together. The header table is taken from ``cabeceras`` (the
    same lines or those of them that may be headers, split alike) and keeps one row per file; with
    ``difundir`` it is sent to the rows, which then stay where they were read.
    """
    es = F.coalesce(F.array_contains("_cs", HEADER_CALL_TIME), F.lit(False))
    es_cabecera = F.col("_posible") & es

    # One header per file (its first header line), reduced to the 1-based position of each wanted
    # name (NULL when absent). The positions are resolved once per file; each data row then picks
    # each column by an integer position instead of comparing fields with names.
    # File provenance is computed here too: once per file, not once per row.
    cab = (partidas if cabeceras is None else cabeceras).where(es_cabecera).groupBy("_ruta").agg(F.min_by("_cs", F.struct("_bloque", "_fila")).alias("_h"))
    cab = cab.withColumn("_primera", F.when(F.col("_h")[0] == OPTIONAL_COLUMN, 2).otherwise(1))

    def posicion(nombre: str) -> Column:
        tras = F.array_position(F.slice("_h", F.col("_primera") + 1, F.size("_h")), nombre).cast("int")
        return F.when(tras > 0, tras + F.col("_primera"))

    cab = cab.select(
        "_ruta", "_primera", *[posicion(h).alias(f"_pos_{c}") for c, h in CAMPOS.items()], *_procedencia(F.col("_ruta"), patron_nombre)
    )
    # Otherwise a plain join: Spark splits a large file's rows.
    datos = partidas.where(~es_cabecera).join(F.broadcast(cab) if difundir else cab, "_ruta", "left")

    def por_nombre(c: str) -> Column:
        # A look-up by position, not a CASE over all fields: that code was too long to be compiled.
        pos = F.col(f"_pos_{c}")
        return F.when(pos.isNotNull(), F.coalesce(F.get("_cs", pos - 1), F.lit("")))

    primera = F.get("_cs", F.when(F.col("_primera") == 2, 1).otherwise(0))
    sel = [F.coalesce(primera, F.lit("")).alias("fecha_txt")]
    sel += [por_nombre(c).alias(c) for c in CAMPOS]
    # Files without a header row get no match: their provenance is computed per row, as a lambda: written out
    # in the generated code of every row it would make a method too long for the JVM to compile.
    suya = F.transform(F.array("_ruta"), lambda r: F.struct(*_procedencia(r, patron_nombre)))
    datos = datos.withColumn("_suya", F.when(F.col("archivo").isNull(), F.get(suya, F.lit(0))))
    motivo = F.when(F.col(f"_pos_{next(iter(CAMPOS))}").isNull(), F.lit("cabecera")).when(F.col("_comilla"), F.lit("comillas"))
    sel += [
        F.coalesce(F.col("archivo"), F.col("_suya.archivo")).alias("archivo"),
        F.when(F.col("archivo").isNotNull(), F.col("salida")).otherwise(F.col("_suya.salida")).alias("salida"),
        F.when(F.col("archivo").isNotNull(), F.col("clave_archivo")).otherwise(F.col("_suya.clave_archivo")).alias("clave_archivo"),
        motivo.alias("motivo_archivo"),
        F.col("_ruta").alias("ruta"),
        F.col("_bloque").alias("bloque"),
        F.col("_fila").alias("fila"),
    ]
    return datos.select(*sel)


def leer_delimitado(
    spark: SparkSession,
    rutas: str | list[str],
    patron_nombre: str = CARGA_RE,
    sep: str = ";",
    encoding: str = "UTF-8",
    multilinea: bool = False,
) -> DataFrame:
    """Read delimited call files aligned by header name.

    Returns text columns ``fecha_txt`` (first column but ``CC``, by position), ``hora_txt
    llamante dur_txt station voice_file log_name resultado`` (by header name; ``''`` when
    empty, NULL when the file lacks the column), ``archivo`` (decoded file name), ``salida``
    and ``clave_archivo`` (from the file name), ``motivo_archivo`` ('cabecera' when the file
    has no recognisable header, 'comillas' when a quoted field is not closed on its line,
    else NULL), the file's whole path (``ruta``) and the row's place in it: ``bloque``, ``fila``.
    Columns not named above (``CC`` and any other) are dropped (S4).
    Patterns of a list that match nothing are passed over; if none matches, the frame is
    empty with these columns (S2). The widest header is looked up now, in one job.

    Rows end at line ends. With ``multilinea`` a quoted value may hold line breaks (as ``\\n``):
    the lines of a record are joined (``unir_registros``); a file still spreads over tasks.
    """
    if multilinea:
        return _leer_multilinea(spark, rutas, patron_nombre, sep, encoding)
    lineas = leer_lineas(spark, rutas, encoding)
    if lineas is None:
        return _vacio(spark)
    cabeceras = posibles_cabeceras(lineas)
    ancho = ancho_de_cabeceras(cabeceras, sep)
    return alinear(partir(lineas, ancho, sep), patron_nombre, partir(cabeceras, ancho, sep), _pocos_archivos(lineas))


# Files whose headers (some hundred bytes each) are sent to every task that reads rows.
ARCHIVOS_DIFUNDIDOS = 50_000


def _pocos_archivos(lineas: DataFrame) -> bool:
    return len(lineas._jdf.inputFiles()) <= ARCHIVOS_DIFUNDIDOS


# Lines of one record at most; a quote that is never closed would make a record of all that follows.
MAX_LINEAS = 10_000


# Text that one task reads where blocks are smaller than that.
BYTES_POR_TAREA = 16 << 20


def _lineas_de_texto(spark: SparkSession, rutas: str | list[str], encoding: str) -> DataFrame | None:
    """Every line, empty ones too (a value may hold them), without a byte order mark."""

    def leer(ruta: str) -> DataFrame:
        valor = F.decode(F.col("value").cast("binary"), encoding)
        valor = F.when(F.startswith(valor, F.lit("\ufeff")), F.substr(valor, F.lit(2))).otherwise(valor)
        return spark.read.text(ruta).select("*", "_metadata").withColumn("_linea", valor).drop("value")

    todas = _cada_patron(rutas, leer)
    if todas is None:
        return None
    # small blocks are read many to a task: a task for each would cost more than reading it
    bloque = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tareas = max(spark.sparkContext.defaultParallelism, -(-todas.rdd.getNumPartitions() // max(1, BYTES_POR_TAREA // bloque)))
    return todas.drop("_metadata").coalesce(tareas)


def _abierta(linea: Column, sep: str) -> Column:
    """Whether a quoted value that starts in ``linea`` goes on behind it: closed values are taken out first."""
    s = re.escape(sep)
    resto = F.regexp_replace(linea, rf'(?:^|(?<={s}))"(?:[^"]++|"")*+"(?={s}|\z)', "")
    return linea.contains('"') & resto.rlike(rf'(?:^|{s})"(?:[^"]++|"")*+\z')  # most lines have no quote


def unir_registros(lineas: DataFrame, sep: str = ";", max_lineas: int = MAX_LINEAS) -> DataFrame:
    """Lines (``leer_lineas``) with the lines of each record joined, in parallel inside a file.

    A line turns "inside a quoted value or not" before it into the same behind it; there are four
    such maps, and they compose. Windows compose them inside each block of a file, for either state at
    its beginning; one summary line a block is composed along the file and sent to the lines, and then
    each line knows its state and the line its record began at. Records inside one block are joined
    there; only the lines of those that go on over a block's end are shuffled. A record of more than
    ``max_lineas`` lines is an unclosed quote: its lines stay apart, marked ``_rota`` (the reader
    quarantines them). With ``_tarea`` (a number that all lines of a block share) as the key of the
    buckets they are stored in, lines inside blocks are not shuffled at all.
    """
    bloque = [*(["_tarea"] if "_tarea" in lineas.columns else []), "_ruta", "_bloque"]
    en_bloque = W.partitionBy(*bloque).orderBy("_fila")
    con_mapa = lineas if "_a" in lineas.columns else lineas.withColumns(_mapa_de_linea(sep))
    e = con_mapa.select(*bloque, "_fila", "_linea", "_a", "_b")
    e = e.withColumn("_giros", F.sum(F.when((F.col("_a") == 1) & (F.col("_b") == 0), 1).otherwise(0)).over(en_bloque))
    fija = F.when(F.col("_a") == F.col("_b"), F.struct(F.col("_a").alias("v"), F.col("_giros").alias("g")))
    e = e.withColumn("_fija", F.last(fija, ignorenulls=True).over(en_bloque))
    # state behind a line: set by the last line that sets it, turned by those after it; and before it
    suelta = F.col("_fija").isNull()
    tras = [F.when(suelta, k + F.col("_giros")).otherwise(F.col("_fija.v") + F.col("_giros") - F.col("_fija.g")) % 2 for k in (0, 1)]
    e = e.select(*bloque, "_fila", "_linea", *[x.cast("int").alias(f"_tras{k}") for k, x in enumerate(tras)])
    e = e.withColumns({f"_ante{k}": F.lag(f"_tras{k}", 1, k).over(en_bloque) for k in (0, 1)})

    b = _estado_de_bloques(e, bloque)
    desde = [F.when(F.col("_inicio") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")).alias(c) for c in ("_ante", "_tras")]
    # a line a block, as the driver holds them for any read
    e = e.join(F.broadcast(b), ["_ruta", "_bloque"]).select(*bloque, "_fila", "_linea", *desde, "_viene", "_ultima", "_sigue")
    e = e.withColumn("_pf", F.last(F.when(F.col("_ante") == 0, F.col("_fila")), ignorenulls=True).over(en_bloque))
    cruza = F.col("_pf").isNull() | (F.col("_sigue") & (F.col("_pf") == F.col("_ultima")))

    cols = ["_ruta", "_bloque", "_fila", "_linea"]
    registro = F.sort_array(F.collect_list(F.struct("_fila", "_linea"))).alias("_r")
    dentro = e.where(~cruza).groupBy(*bloque, "_pf").agg(registro).withColumn("_rota", F.size("_r") > max_lineas)
    unida = F.array(F.struct(F.col("_pf").alias("_fila"), F.array_join(F.col("_r._linea"), "\n").alias("_linea")))
    dentro = dentro.select("_ruta", "_bloque", "_rota", F.inline(F.when(F.col("_rota"), F.col("_r")).otherwise(unida)))

    principio = F.when(F.col("_pf").isNotNull(), F.struct(F.col("_bloque").alias("pb"), F.col("_pf").alias("pf"))).otherwise(F.col("_viene"))
    cruzan = e.where(cruza).select(*cols, principio.alias("_p"))
    cruzan = cruzan.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("_ruta", "_p")))
    sueltas = cruzan.where(F.col("_n") > max_lineas).select(*cols, F.lit(True).alias("_rota"))
    registro = F.sort_array(F.collect_list(F.struct("_bloque", "_fila", "_linea")))
    unidas = (
        cruzan.where(F.col("_n") <= max_lineas).groupBy("_ruta", "_p").agg(registro.alias("_r"))
        .select("_ruta", F.col("_p.pb").alias("_bloque"), F.col("_p.pf").alias("_fila"), F.array_join(F.col("_r._linea"), "\n").alias("_linea"),
                F.lit(False).alias("_rota"))
    )
    return dentro.select(*cols, "_rota").unionByName(unidas).unionByName(sueltas)


def _mapa_de_linea(sep: str) -> dict[str, Column]:
    """The state behind a line that begins outside (``_a``) or inside (``_b``) a quoted value: 1 is inside."""
    linea = F.col("_linea")
    dentro = F.when(linea.contains('"'), _abierta(F.concat(F.lit('"'), linea), sep)).otherwise(True)
    return {"_a": _abierta(linea, sep).cast("int"), "_b": dentro.cast("int")}


def _estado_de_bloques(e: DataFrame, bloque: list[str]) -> DataFrame:
    """For each block: whether it begins inside a quoted value (``_inicio``) and ends in one (``_sigue``), the line
    where its last record began (``_ultima``), and the place where a record that comes in from before began (``_viene``)."""
    principios = [F.max(F.when(F.col(f"_ante{k}") == 0, F.col("_fila"))).alias(f"_u{k}") for k in (0, 1)]
    b = e.groupBy(*bloque).agg(F.max_by(F.struct("_tras0", "_tras1"), "_fila").alias("_m"), *principios)
    previos = W.partitionBy("_ruta").orderBy("_bloque").rowsBetween(W.unboundedPreceding, -1)
    hasta = W.partitionBy("_ruta").orderBy("_bloque")
    gira = (F.col("_m._tras0") == 1) & (F.col("_m._tras1") == 0)
    b = b.withColumn("_suma", F.sum(gira.cast("int")).over(hasta))
    puesta = F.when(F.col("_m._tras0") == F.col("_m._tras1"), F.struct(F.col("_m._tras0").alias("v"), F.col("_suma").alias("s")))
    b = b.withColumn("_ult", F.last(puesta, ignorenulls=True).over(previos)).withColumn("_antes", F.coalesce(F.max("_suma").over(previos), F.lit(0)))
    b = b.withColumn("_inicio", ((F.coalesce(F.col("_ult.v") - F.col("_ult.s"), F.lit(0)) + F.col("_antes")) % 2).cast("int"))
    es0 = F.col("_inicio") == 0
    b = b.withColumn("_ultima", F.when(es0, F.col("_u0")).otherwise(F.col("_u1")))
    b = b.withColumn("_sigue", F.when(es0, F.col("_m._tras0")).otherwise(F.col("_m._tras1")) == 1)
    desde = F.when(F.col("_ultima").isNotNull(), F.struct(F.col("_bloque").alias("pb"), F.col("_ultima").alias("pf")))
    return b.select("_ruta", "_bloque", "_inicio", "_ultima", "_sigue", F.last(desde, ignorenulls=True).over(previos).alias("_viene"))


# Buckets of the lines' copy at most.
MAX_CUBOS = 10_000


def _leer_multilinea(spark: SparkSession, rutas: str | list[str], patron_nombre: str, sep: str, encoding: str) -> DataFrame:
    lineas = _lineas_de_texto(spark, rutas, encoding)
    if lineas is None:
        return _vacio(spark)
    # the lines with their places are written once, in buckets by the task that read them: joining records goes
    # through them several times, and a block's lines are then together without a shuffle; the records are written once too
    copia, juntos = carpeta_de_trabajo(spark, "registros"), carpeta_de_trabajo(spark, "registros")
    tareas, tabla = lineas.rdd.getNumPartitions(), f"registros_{copia.rsplit('/', 1)[1]}"
    escritor = lineas.withColumns({"_tarea": F.spark_partition_id(), **_mapa_de_linea(sep)}).write.bucketBy(min(4 * tareas, MAX_CUBOS), "_tarea")  # few share one
    try:
        escritor.option("path", copia).saveAsTable(tabla)
        registros = unir_registros(spark.table(tabla), sep).where(F.trim("_linea") != "")
        registros.write.parquet(juntos)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {tabla}")
        borrar_carpeta(spark, copia)
    registros = spark.read.schema(registros.schema).parquet(juntos)
    cabeceras = posibles_cabeceras(registros, tareas)
    ancho = ancho_de_cabeceras(cabeceras, sep)
    return alinear(partir(registros, ancho, sep), patron_nombre, partir(cabeceras, ancho, sep), _pocos_archivos(lineas))


def leer_cargas(
    spark: SparkSession,
    directorio: str,
    salida: str = "",
    encoding: str = "UTF-8",
    sep: str = ";",
) -> DataFrame:
    """All months' load files of one output name."""
    return leer_delimitado(spark, patron_cargas(directorio, salida), CARGA_RE, sep, encoding)


def leer_exportaciones(
    spark: SparkSession,
    directorio: str,
    period: Period,
    salida: str = "",
    ext: str = "csv",
    encoding: str = "UTF-8",
    sep: str = ";",
) -> DataFrame:
    """One month's daily exports of one output name, concatenated by column name."""
    return leer_delimitado(
        spark, patron_exportaciones(directorio, period, salida, ext), EXPORT_RE, sep, encoding
    )


def carga_mensual(crudo: DataFrame, primera: str = "Call day") -> DataFrame:
    """K1 input: aligned export rows in the load-file layout.

    Columns: ``primera`` (the call day text), the load-file header names in
    their order, then ``salida`` ('' when none) and ``anio_mes`` (YYYYMM from
    the export's day key) to partition the write by. ``CC`` is already gone.
    """
    cols = [F.col("fecha_txt").alias(primera)] + [F.col(c).alias(h) for c, h in CAMPOS.items()]
    return crudo.select(
        *cols,
        F.coalesce(F.col("salida"), F.lit("")).alias("salida"),
        F.substring(F.col("clave_archivo"), 1, 6).alias("anio_mes"),
    )
