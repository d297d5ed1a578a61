"""Registered queries of maintained tables: replaced slices, named files, roll-up, buckets, replay, long records.

All start from the generated tables as ``catalog_load`` does; outputs stand under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog_load import _AGENTE, _ESTACION, _LLAMANTE, LLAMADA, ORDEN, RESULTADO, _destino, _lineas, _programas, _textos
from .functions.normalize import periodo_valido, rango_valido
from .functions.present import portable
from .model import Period
from .operators.filters import es_miembro
from .plans import cubos, estados, ingest, reports
from .session import carpeta_de_trabajo
from .sources import files, sinks
from .sources import tables as t

# Months with lines that cannot be read at first, and those of them that are corrected.
MALOS, CORREGIDOS = ("199701", "199712"), ("199701", "199706")
VACIO = "199705"
MES = Period(1998, 11)


def _carga(lineas: DataFrame) -> DataFrame:
    """Lines in the load-file layout, with what names and orders them."""
    return lineas.drop("CC", "_par")


def _publicar_origen(spark: SparkSession, d: str, directorio: str, donde: str = "true", **fijos: str) -> list[str]:
    """All lines, or those where ``donde`` holds, under their files' names; the rows travel as they are stored, their texts (and
    ``fijos``: columns with one text) are made where a file is written. Returns the fields of a line."""
    filas = t.tabla(spark, d, "lineitem").select(*ORDEN, "l_returnflag", "l_linestatus", *_destino()).where(donde)

    def presentar(df: DataFrame) -> DataFrame:
        return df.select(*_textos(), "salida", "anio_mes").withColumns({c: F.lit(v) for c, v in fijos.items()})

    sinks.publicar(filas, directorio, orden=ORDEN, presentar=presentar)
    return filas.select(*_textos()).columns


def _publicadas(directorio: str) -> str:
    return f"{directorio}/?????? *to_access.csv"


def q_carga_corregida(spark, d):
    """Files with unreadable lines loaded, some corrected in place, loaded again: calls and quarantine."""
    base = carpeta_de_trabajo(spark, "catalogo")
    lineas = _carga(_lineas(spark, d)).where("salida <> 'S2'")
    rota = F.col("anio_mes").between(*MALOS) & (F.col("_orden.l_orderkey") % 4 == 1)
    sinks.publicar(lineas.withColumn("Length", F.when(rota, "?").otherwise(F.col("Length"))), f"{base}/origen", orden=["_orden"])
    for vez in range(2):
        if vez:
            corregidas = lineas.where(F.col("anio_mes").between(*CORREGIDOS))
            sinks.publicar(corregidas, f"{base}/origen", orden=["_orden"])
        crudo = files.leer_delimitado(spark, _publicadas(f"{base}/origen"))
        ingest.ingerir(spark, f"{base}/llamadas", crudo, _programas(spark), destino_cuarentena=f"{base}/cuarentena",
                       leidos=files.archivos(spark, _publicadas(f"{base}/origen")))
    buenas = spark.read.schema(ingest.TABLA).parquet(f"{base}/llamadas")
    buenas = buenas.groupBy(F.lit("llamadas").alias("tabla"), F.col("programa_id").cast("string").alias("de"), F.replace("anio_mes", F.lit("-"), F.lit("")).alias("mes"))
    malas = spark.read.parquet(f"{base}/cuarentena").groupBy(F.col("motivo").alias("tabla"), F.col("salida").alias("de"), F.col("clave_archivo").alias("mes"))
    n = F.count(F.lit(1)).alias("filas")
    return buenas.agg(n, F.sum("dur").cast("bigint").alias("segundos")).unionByName(malas.agg(n, F.lit(0).cast("bigint").alias("segundos")))


def _solo_cabecera(spark: SparkSession, directorio: str, mes: str, salidas: list[str], columnas: list[str]) -> None:
    """A month's files that hold a header line and nothing else."""
    for s in salidas:
        fs, camino = sinks._sistema(spark, f"{directorio}/{sinks.nombre_de_carga(mes, s)}")
        salida = fs.create(camino, True)
        salida.write(bytearray((";".join(columnas) + "\n").encode()))
        salida.close()


def q_consolidar_mes_vacio(spark, d):
    """K4: months consolidated, the files of one month emptied, consolidated again: that month is gone."""
    base = carpeta_de_trabajo(spark, "catalogo")
    cols = _publicar_origen(spark, d, f"{base}/origen")
    for vez in range(2):
        if vez:
            _solo_cabecera(spark, f"{base}/origen", VACIO, ["S0", "S1", "S2"], cols)
        leidos = files.archivos(spark, _publicadas(f"{base}/origen"))
        mensual = files.carga_mensual(files.leer_delimitado(spark, _publicadas(f"{base}/origen")))
        sinks.escribir_delimitado(mensual, f"{base}/carpetas", ("salida", "anio_mes"), tramos=leidos)
        sinks.publicar(mensual, f"{base}/archivos", tramos=leidos)
    partes = [
        files.leer_delimitado(spark, p).groupBy(F.lit(f).alias("forma"), "salida", "clave_archivo").agg(F.count(F.lit(1)).alias("filas"))
        for f, p in (("carpetas", f"{base}/carpetas/*/*/*.csv"), ("archivos", _publicadas(f"{base}/archivos")))
    ]
    return partes[0].unionByName(partes[1])


def q_orden_de_carpetas(spark, d):
    """Equally named files in two folders, patterns given in either order: the same rows win."""
    base = carpeta_de_trabajo(spark, "catalogo")
    for carpeta in ("a", "b"):
        _publicar_origen(spark, d, f"{base}/{carpeta}", "salida <> 'S2'", **{"Call result": carpeta})
    salidas = []
    for vez, orden in enumerate((["a", "b"], ["b", "a"])):
        crudo = files.leer_delimitado(spark, [_publicadas(f"{base}/{c}") for c in orden])
        ingest.ingerir(spark, f"{base}/llamadas{vez}", crudo, _programas(spark))
        tabla = spark.read.schema(ingest.TABLA).parquet(f"{base}/llamadas{vez}")
        salidas.append(tabla.groupBy(F.lit(vez).cast("bigint").alias("vez"), "programa_id", "resultado").agg(
            F.count(F.lit(1)).alias("filas"), F.sum("dur").cast("bigint").alias("segundos")))
    return salidas[0].unionByName(salidas[1])


def q_cargas_por_nombre(spark, d):
    """K1 -> S5, S6, S8: monthly files under their names (larger ones as folders), read back by output name."""
    base = carpeta_de_trabajo(spark, "catalogo")
    sinks.publicar(_carga(_lineas(spark, d)), base, orden=["_orden"], filas_por_archivo=200)
    leidas = [files.leer_cargas(spark, base, f"S{k}") for k in range(3)]
    todas = leidas[0].unionByName(leidas[1]).unionByName(leidas[2])
    return todas.select("fecha_txt", *files.CAMPOS, "salida", "clave_archivo")


def q_exportaciones_mes(spark, d):
    """The daily exports of one month and output name among those of several, by file name."""
    base = carpeta_de_trabajo(spark, "catalogo")
    dia = F.date_format(F.to_date("Call day", "d/M/yyyy"), "yyyyMMdd").alias("dia")
    lineas = _carga(_lineas(spark, d)).where(F.col("anio_mes").isin("199810", "199811", "199812"))
    lineas = lineas.select(*[c for c in lineas.columns if c not in ("anio_mes", "_orden")], dia)
    sinks.publicar(lineas, base, "dia", sinks.nombre_de_exportacion)
    leidas = [files.leer_exportaciones(spark, base, MES, f"S{k}") for k in range(2)]
    return leidas[0].unionByName(leidas[1]).select("fecha_txt", *files.CAMPOS, "salida", "clave_archivo")


def q_llamadas_de_elegidos(spark, d):
    """Calls of chosen agents, chosen by a table and by a list."""
    calls, agentes = t.llamadas(spark, d), t.tabla(spark, d, "supplier")
    elegidos = agentes.where("s_acctbal > 4000").select(F.col("s_suppkey").cast("string").alias("log_name"))
    n = F.count(F.lit(1)).alias("llamadas")
    por_tabla = es_miembro(calls, elegidos).groupBy(F.lit("tabla").alias("forma"), "log_name").agg(n)
    por_lista = es_miembro(calls, ["3", "5", "8"]).groupBy(F.lit("lista").alias("forma"), "log_name").agg(n)
    return por_tabla.unionByName(por_lista).unionByName(es_miembro(calls, []).groupBy(F.lit("nada").alias("forma"), "log_name").agg(n))


def q_escritura_fallida(spark, d):
    """K6: writes that fail in the middle leave what was there."""
    base = carpeta_de_trabajo(spark, "catalogo")
    lineas = _carga(_lineas(spark, d))
    pares = lineas.where(F.col("_orden.l_orderkey") % 2 == 0)
    rotas = lineas.withColumn("Length", F.when(F.col("_orden.l_orderkey") % 97 == 1, F.raise_error(F.lit("on purpose")).cast("string")).otherwise(F.col("Length")))

    def escrituras(df):
        plano = df.drop("_orden")
        return (
            lambda: sinks.anexar(df.select(F.col("Length").alias("dur"), "salida", "anio_mes"), f"{base}/tabla", ["anio_mes"]),
            lambda: sinks.escribir_delimitado(plano, f"{base}/carpetas", ("salida", "anio_mes")),
            lambda: sinks.publicar(plano, f"{base}/archivos"),
        )

    for escribir in escrituras(pares):
        escribir()
    fallos = 0
    for escribir in escrituras(rotas):
        try:
            escribir()
        except Exception:  # the error that the rows raise
            fallos += 1
    quedan = [
        spark.read.parquet(f"{base}/tabla").select(F.lit("tabla").alias("forma"), "salida"),
        files.leer_delimitado(spark, f"{base}/carpetas/*/*/*.csv").select(F.lit("carpetas").alias("forma"), "salida"),
        files.leer_delimitado(spark, _publicadas(f"{base}/archivos")).select(F.lit("archivos").alias("forma"), "salida"),
    ]
    todas = quedan[0].unionByName(quedan[1]).unionByName(quedan[2])
    return todas.groupBy("forma", "salida").agg(F.count(F.lit(1)).alias("filas"), F.lit(fallos).cast("bigint").alias("fallos"))


def q_periodos_validos(spark, d):
    """P12, P13 as columns over periods and day ranges derived from the orders."""
    o = t.tabla(spark, d, "orders")
    anio = (F.year("o_orderdate") + F.col("o_orderkey") % 60).cast("int").alias("anio")
    mes = (F.col("o_orderkey") % 15).cast("int").alias("mes")
    ini, fin = ((F.col("o_custkey") % 35) - 1).alias("ini"), (F.col("o_orderkey") % 33).alias("fin")
    p = o.select("o_orderkey", anio, mes, ini, fin)
    return p.select(
        "o_orderkey", "anio", "mes", "ini", "fin", periodo_valido("anio", "mes").alias("periodo"),
        rango_valido("anio", "mes", F.col("ini"), F.col("fin")).alias("rango"),
    )


LOTES = (("1992-01-01", "1996-07-01"), ("1996-01-01", "1998-01-01"), ("1997-06-01", "2100-01-01"))


def _lotes(spark, d):
    """Three loads of the calls whose days overlap."""
    calls = t.llamadas(spark, d).withColumn("programa_id", F.col("programa_id").cast("int"))
    calls = calls.withColumn(ingest.PARTICION, F.date_format("fecha", "yyyy-MM"))
    for desde, hasta in LOTES:
        yield calls.where((F.col("fecha") >= F.lit(desde).cast("date")) & (F.col("fecha") < F.lit(hasta).cast("date")))


def _estados(spark, d):
    """States after three overlapping loads, the last of them broken off before its states were stored."""
    base = carpeta_de_trabajo(spark, "catalogo")
    for k, lote in enumerate(_lotes(spark, d)):
        estados.cargar(spark, f"{base}/llamadas", f"{base}/estados", lote)
        if k == 1:
            estados.compactar(spark, f"{base}/estados")
    meses = [(f"1998-{m:02d}",) for m in range(1, 13)]
    spark.createDataFrame(meses, f"{ingest.PARTICION} string").coalesce(1).write.parquet(f"{base}/estados/pendientes/rota")
    return estados.leer(spark, f"{base}/llamadas", f"{base}/estados")


def q_estados_dias_con_total(spark, d):
    """R2 from the maintained states."""
    dims = (t.agentes(spark, d), t.grupos(spark, d), t.programas(spark, d))
    _, r2, _ = estados.informes_dias(_estados(spark, d), *dims)
    return portable(r2.withColumn("grupo", F.col("grupo").cast("string")).withColumn("programa_id", F.col("programa_id").cast("bigint")))


def q_estados_media(spark, d):
    """R4 from the maintained states, by month."""
    return portable(estados.media_por_agente(_estados(spark, d), mensual=True).withColumn("programa_id", F.col("programa_id").cast("bigint")))


def q_carga_en_cubos(spark, d):
    """K2 into a table in buckets by (fecha, log_name): three overlapping loads, NULL names never conflict."""
    nombre = "llamadas_" + carpeta_de_trabajo(spark, "catalogo").rsplit("/", 1)[1]
    cubos.crear(spark, nombre, carpeta_de_trabajo(spark, "catalogo"), 8, ["fecha", "log_name"])
    for lote in _lotes(spark, d):
        cubos.cargar(spark, nombre, lote.withColumn("log_name", F.when(F.col("log_name").cast("int") % 13 != 0, F.col("log_name"))))
    return portable(spark.table(nombre).select("fecha", "log_name", "llamante", "dur", "programa_id"))


def q_cuarentena_reprocesada(spark, d):
    """Rows of an output name with two programmes, replayed after one of them was closed, twice."""
    base = carpeta_de_trabajo(spark, "catalogo")
    _publicar_origen(spark, d, f"{base}/origen")
    crudo = files.leer_delimitado(spark, _publicadas(f"{base}/origen"))
    ingest.ingerir(spark, f"{base}/llamadas", crudo, _programas(spark), destino_cuarentena=f"{base}/cuarentena")
    ahora = _programas(spark).withColumn("activo", F.when(F.col("id") == 5, 0).otherwise(F.col("activo")))
    for _ in range(2):
        ingest.reprocesar(spark, f"{base}/llamadas", f"{base}/cuarentena", ahora)
    return portable(spark.read.schema(ingest.TABLA).parquet(f"{base}/llamadas").select(*LLAMADA))


def q_registros_multilinea(spark, d):
    """S5 with line breaks inside quoted values, from files cut into many blocks."""
    base = carpeta_de_trabajo(spark, "catalogo")
    lineas = _carga(_lineas(spark, d)).drop("_orden")
    con_saltos = F.when(F.length("Caller") % 2 == 0, F.concat(F.lit("a\n"), "Voice file", F.lit('\n\n;"b"'))).otherwise(F.col("Station"))
    lineas.withColumn("Station", con_saltos).drop("salida", "anio_mes").write.options(
        header=True, sep=";", escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{base}/origen")
    claves = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k"}
    antes = {k: spark.conf.get(k) for k in claves}
    try:
        for k, v in claves.items():
            spark.conf.set(k, v)
        leidas = files.leer_delimitado(spark, f"{base}/origen/*.csv", multilinea=True)
    finally:
        for k, v in antes.items():
            spark.conf.set(k, v)
    # the lines were read in small blocks above, their joined records are written in tasks of the session's size
    leidas.select("fecha_txt", *files.CAMPOS, "motivo_archivo").write.parquet(f"{base}/leidas")
    return spark.read.parquet(f"{base}/leidas")


QUERIES = {
    "carga_corregida": q_carga_corregida,
    "consolidar_mes_vacio": q_consolidar_mes_vacio,
    "orden_de_carpetas": q_orden_de_carpetas,
    "cargas_por_nombre": q_cargas_por_nombre,
    "exportaciones_mes": q_exportaciones_mes,
    "llamadas_de_elegidos": q_llamadas_de_elegidos,
    "escritura_fallida": q_escritura_fallida,
    "periodos_validos": q_periodos_validos,
    "estados_dias_con_total": q_estados_dias_con_total,
    "estados_media": q_estados_media,
    "carga_en_cubos": q_carga_en_cubos,
    "cuarentena_reprocesada": q_cuarentena_reprocesada,
    "registros_multilinea": q_registros_multilinea,
}

_CLAVE = f"CAST(l_shipdate AS DATE), l_linenumber, l_partkey % 60, l_suppkey % 60, {_LLAMANTE}, {_AGENTE}, l_partkey % 3"
_ORDEN = "l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_shipdate, l_quantity"
_DUR = "CAST(trunc(round(l_extendedprice, 2)) AS INTEGER)"
_FECHA_TXT = "printf('%d/%d/%d', day(l_shipdate), month(l_shipdate), year(l_shipdate))"
_HORA_TXT = "printf('%d:%02d:%02d', l_linenumber + 8, l_partkey % 60, l_suppkey % 60)"
_DUR_TXT = "replace(printf('%.2f', l_extendedprice), '.', ',')"
_SALIDA = "'S' || CAST(l_partkey % 3 AS VARCHAR)"


def _leidas_sql(clave: str, donde: str) -> str:
    return f"""
SELECT {_FECHA_TXT} AS fecha_txt, {_HORA_TXT} AS hora_txt, {_LLAMANTE} AS llamante, {_DUR_TXT} AS dur_txt, {_ESTACION} AS station,
       l_linestatus AS voice_file, {_AGENTE} AS log_name, '{RESULTADO}' AS resultado, {_SALIDA} AS salida,
       strftime(l_shipdate, '{clave}') AS clave_archivo
FROM lineitem WHERE {donde}
"""


def oraculos(bloques: dict[str, str]) -> dict[str, str]:
    """The DuckDB oracles. ``bloques``: the report blocks that the catalog shares."""
    lotes = " UNION ALL ".join(
        f"SELECT {k} AS lote, l.* FROM lineitem l WHERE l_shipdate >= TIMESTAMP '{a}' AND l_shipdate < TIMESTAMP '{b}'" for k, (a, b) in enumerate(LOTES)
    )
    mala = f"strftime(l_shipdate, '%Y%m') BETWEEN '{MALOS[0]}' AND '{MALOS[1]}' AND l_orderkey % 4 = 1"
    corregida = f"strftime(l_shipdate, '%Y%m') BETWEEN '{CORREGIDOS[0]}' AND '{CORREGIDOS[1]}'"
    return {
        "carga_corregida": f"""
WITH filas AS (
    SELECT *, {mala} AS mala, {corregida} AS corregida, dense_rank() OVER (ORDER BY {_CLAVE}) AS k FROM lineitem WHERE l_partkey % 3 <> 2),
  uno AS (SELECT * FROM filas WHERE NOT mala QUALIFY row_number() OVER (PARTITION BY k ORDER BY {_ORDEN}) = 1),
  dos AS (SELECT * FROM filas WHERE (NOT mala OR corregida) AND k NOT IN (SELECT k FROM uno)
          QUALIFY row_number() OVER (PARTITION BY k ORDER BY {_ORDEN}) = 1)
SELECT 'llamadas' AS tabla, CAST(l_partkey % 3 + 1 AS VARCHAR) AS de, strftime(l_shipdate, '%Y%m') AS mes, count(*) AS filas,
       CAST(sum({_DUR}) AS BIGINT) AS segundos
FROM (SELECT * FROM uno UNION ALL SELECT * FROM dos) GROUP BY 2, 3
UNION ALL
SELECT 'dur', {_SALIDA}, strftime(l_shipdate, '%Y%m'), count(*), 0 FROM filas WHERE mala AND NOT corregida GROUP BY 2, 3
""",
        "consolidar_mes_vacio": f"""
SELECT forma, {_SALIDA} AS salida, strftime(l_shipdate, '%Y%m') AS clave_archivo, count(*) AS filas
FROM lineitem, (VALUES ('carpetas'), ('archivos')) f(forma) WHERE strftime(l_shipdate, '%Y%m') <> '{VACIO}' GROUP BY 1, 2, 3
""",
        "orden_de_carpetas": f"""
WITH uno AS (SELECT * FROM lineitem WHERE l_partkey % 3 <> 2 QUALIFY row_number() OVER (PARTITION BY {_CLAVE} ORDER BY {_ORDEN}) = 1)
SELECT vez, CAST(l_partkey % 3 + 1 AS INTEGER) AS programa_id, 'a' AS resultado, count(*) AS filas, CAST(sum({_DUR}) AS BIGINT) AS segundos
FROM uno, (VALUES (CAST(0 AS BIGINT)), (1)) v(vez) GROUP BY 1, 2
""",
        "cargas_por_nombre": _leidas_sql("%Y%m", "true"),
        "exportaciones_mes": _leidas_sql("%Y%m%d", "strftime(l_shipdate, '%Y%m') = '199811' AND l_partkey % 3 <> 2"),
        "llamadas_de_elegidos": """
SELECT 'tabla' AS forma, CAST(l_suppkey AS VARCHAR) AS log_name, count(*) AS llamadas
FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 4000) GROUP BY 2
UNION ALL SELECT 'lista', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem WHERE l_suppkey IN (3, 5, 8) GROUP BY 2
""",
        "escritura_fallida": f"""
SELECT forma, {_SALIDA} AS salida, count(*) AS filas, CAST(3 AS BIGINT) AS fallos
FROM lineitem, (VALUES ('tabla'), ('carpetas'), ('archivos')) f(forma) WHERE l_orderkey % 2 = 0 GROUP BY 1, 2
""",
        "periodos_validos": """
WITH p AS (
    SELECT o_orderkey, CAST(year(o_orderdate) + o_orderkey % 60 AS INTEGER) AS anio, CAST(o_orderkey % 15 AS INTEGER) AS mes,
           o_custkey % 35 - 1 AS ini, o_orderkey % 33 AS fin FROM orders)
SELECT *, mes BETWEEN 1 AND 12 AND anio BETWEEN 2017 AND 2049 AS periodo,
       CASE WHEN mes BETWEEN 1 AND 12 THEN ini >= 1 AND ini <= fin AND fin <= day(last_day(make_date(anio, mes, 1))) ELSE false END AS rango
FROM p
""",
        "estados_dias_con_total": f"WITH {bloques['calls']}, {bloques['per_agent']}, {bloques['det']}\n{bloques['r2']}",
        "estados_media": """
WITH unas AS (
    SELECT *, CAST(l_quantity AS INTEGER) AS dur FROM lineitem
    QUALIFY row_number() OVER (
      PARTITION BY CAST(l_shipdate AS DATE), strftime(l_shipdate, '%H:%M:%S'), l_orderkey, l_suppkey, l_partkey
      ORDER BY CAST(l_quantity AS INTEGER), l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR)) = 1),
  s AS (
    SELECT l_partkey AS programa_id, CAST(year(l_shipdate) AS INTEGER) AS anio, CAST(month(l_shipdate) AS INTEGER) AS mes,
           CAST(l_suppkey AS VARCHAR) AS log_name, CAST(sum(dur) AS BIGINT) AS tot_sec, count(*) AS num_llamadas
    FROM unas GROUP BY 1, 2, 3, 4),
  m AS (SELECT *, tot_sec // num_llamadas AS media_seg FROM s)
SELECT programa_id, anio, mes, log_name, printf('%02d:%02d:%02d', media_seg // 3600, (media_seg // 60) % 60, media_seg % 60) AS dur_media,
       media_seg, tot_sec, num_llamadas
FROM m
""",
        "carga_en_cubos": f"""
WITH lotes AS ({lotes}),
  con AS (
    SELECT * FROM lotes WHERE l_suppkey % 13 <> 0
    QUALIFY row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE), l_suppkey
      ORDER BY lote, strftime(l_shipdate, '%H:%M:%S'), CAST(l_orderkey AS VARCHAR), CAST(l_quantity AS INTEGER), l_returnflag, l_linestatus,
               CAST(l_linenumber AS VARCHAR), l_partkey) = 1)
SELECT strftime(l_shipdate, '%Y-%m-%d') AS fecha, CAST(l_suppkey AS VARCHAR) AS log_name, CAST(l_orderkey AS VARCHAR) AS llamante,
       CAST(l_quantity AS INTEGER) AS dur, CAST(l_partkey AS INTEGER) AS programa_id FROM con
UNION ALL
SELECT strftime(l_shipdate, '%Y-%m-%d'), NULL, CAST(l_orderkey AS VARCHAR), CAST(l_quantity AS INTEGER), CAST(l_partkey AS INTEGER)
FROM lotes WHERE l_suppkey % 13 = 0
""",
        "cuarentena_reprocesada": f"""
SELECT strftime(l_shipdate, '%Y-%m-%d') AS fecha, printf('%02d:%02d:%02d', l_linenumber + 8, l_partkey % 60, l_suppkey % 60) AS hora,
       {_LLAMANTE} AS llamante, {_DUR} AS dur, {_ESTACION} AS station, l_linestatus AS voice_file, {_AGENTE} AS log_name,
       '{RESULTADO}' AS resultado, CAST(l_partkey % 3 + 1 AS INTEGER) AS programa_id
FROM lineitem QUALIFY row_number() OVER (PARTITION BY {_CLAVE} ORDER BY {_ORDEN}) = 1
""",
        "registros_multilinea": f"""
SELECT {_FECHA_TXT} AS fecha_txt, {_HORA_TXT} AS hora_txt, {_LLAMANTE} AS llamante, {_DUR_TXT} AS dur_txt,
       CASE WHEN length({_LLAMANTE}) % 2 = 0 THEN 'a' || chr(10) || l_linestatus || chr(10) || chr(10) || ';"b"' ELSE {_ESTACION} END AS station,
       l_linestatus AS voice_file, {_AGENTE} AS log_name, '{RESULTADO}' AS resultado, CAST(NULL AS VARCHAR) AS motivo_archivo
FROM lineitem
""",
    }
