"""Registered queries of the load path (S*, K*, X3): ``lineitem`` as export files and back.

Every lineitem row is written as a line of a delimited export, read back by header name,
normalised, tagged with its programme and loaded; the DuckDB oracles start from ``lineitem``.
The files hold two header layouts (``CC`` in the middle, ``CC`` first), empty callers and
logins, and values with the separator and quotes. Outputs stand under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.present import portable
from .operators.filters import activos, excluir_agentes, programa_por_id
from .operators.load import insertar_ignorando
from .operators.orden import numerar
from .plans import ingest, reports
from .session import carpeta_de_trabajo
from .sources import files, sinks
from .sources import tables as t

# Rows shipped before this day are stored already.
CORTE = "1998-01-01"
RESULTADO = "Request for information without order"
LLAMADA = ["fecha", "hora", "llamante", "dur", "station", "voice_file", "log_name", "resultado", "programa_id"]


# What orders the lines of a file.
ORDEN = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate", "l_quantity"]


def _textos() -> list[Column]:
    """The text fields of an export line, from a lineitem row."""
    hora = F.format_string("%d:%02d:%02d", F.col("l_linenumber") + 8, F.col("l_partkey") % 60, F.col("l_suppkey") % 60)
    estacion = F.when(F.col("l_partkey") % 5 == 0, F.concat(F.lit('A;"'), F.col("l_returnflag"), F.lit('" '))).otherwise(
        F.col("l_returnflag")
    )
    return [
        F.date_format("l_shipdate", "d/M/yyyy").alias("Call day"),
        hora.alias("Call time"),
        F.when(F.col("l_orderkey") % 7 == 0, "").otherwise(F.col("l_orderkey").cast("string")).alias("Caller"),
        F.translate(F.format_string("%.2f", "l_extendedprice"), ".", ",").alias("Length"),
        estacion.alias("Station"),
        F.col("l_linestatus").alias("Voice file"),
        F.when(F.col("l_suppkey") % 11 == 0, "").otherwise(F.col("l_suppkey").cast("string")).alias("Login name"),
        F.lit(RESULTADO).alias("Call result"),
    ]


def _destino() -> list[Column]:
    """Output name and month of a lineitem row."""
    return [F.concat(F.lit("S"), F.col("l_partkey") % 3).alias("salida"), F.date_format("l_shipdate", "yyyyMM").alias("anio_mes")]


def _lineas(spark: SparkSession, d: str) -> DataFrame:
    """Every lineitem row as the text fields of an export line, with its output name and month."""
    li = t.tabla(spark, d, "lineitem")
    return li.select(
        *_textos(), F.lit("x").alias("CC"), *_destino(), (F.dayofmonth("l_shipdate") % 2).alias("_par"), F.struct(*ORDEN).alias("_orden")
    )


def _escribir(spark: SparkSession, d: str) -> list[str]:
    """The lines as files: one for each output name, month and layout, in order. Returns their patterns.

    The rows travel and are sorted as they are stored, their texts are made where a file is written."""
    base = carpeta_de_trabajo(spark, "catalogo")
    filas = t.tabla(spark, d, "lineitem").select(
        *ORDEN, "l_returnflag", "l_linestatus", *_destino(), (F.dayofmonth("l_shipdate") % 2).alias("_par")
    )
    campos = filas.select(*_textos()).columns
    disposiciones = {0: [*campos[:4], "CC", *campos[4:]], 1: ["CC", *campos]}
    for par, cols in disposiciones.items():
        una = sinks._sin_nulos(filas.where(F.col("_par") == par), ("salida", "anio_mes")).repartition("salida", "anio_mes")
        una = una.sortWithinPartitions("salida", "anio_mes", *ORDEN)
        una = una.select(*_textos(), F.lit("x").alias("CC"), "salida", "anio_mes").select(*cols, "salida", "anio_mes")
        sinks.escribir_delimitado(una, f"{base}/{par}", ("salida", "anio_mes"))
    return [f"{base}/{par}/*/*/*.csv" for par in disposiciones] + [f"{base}/none/*.csv"]


def _programas(spark: SparkSession) -> DataFrame:
    """S0 and S1 belong to one active programme each, S2 to two."""
    return spark.sql(
        "SELECT * FROM VALUES (1, 'S0', 1), (2, 'S1', 1), (4, 'S1', 0), (3, 'S2', 1), (5, 'S2', 1) "
        "AS p(id, nombre_salida, activo)"
    )


def _almacenadas(spark: SparkSession, d: str) -> DataFrame:
    """The calls that are stored before the load."""
    li = _lineas(spark, d).where(F.col("_orden.l_shipdate") < F.lit(CORTE).cast("timestamp_ntz")).where("salida <> 'S2'")
    p = _programas(spark).where("activo = 1").select("nombre_salida", F.col("id").alias("programa_id"))
    li = li.join(p, li["salida"] == p["nombre_salida"])
    return li.select(
        F.to_date("Call day", "d/M/yyyy").alias("fecha"),
        F.concat(F.lpad(F.split("Call time", ":")[0], 2, "0"), F.substring_index("Call time", ":", -2).alias("r")).alias("hora"),
        F.col("Caller").alias("llamante"),
        F.col("Login name").alias("log_name"),
        "programa_id",
    ).withColumn("hora", F.concat(F.substring("hora", 1, 2), F.lit(":"), F.substring("hora", 3, 5)))


def q_carga_exportaciones(spark, d):
    """X3 up to the append: the rows an insert-ignore of the files adds to the stored calls."""
    crudo = files.leer_delimitado(spark, _escribir(spark, d))
    lote, _ = ingest.preparar(crudo, _programas(spark))
    nuevas = insertar_ignorando(_almacenadas(spark, d), lote, ingest.DEFAULT_KEY, order_cols=ingest.LUGAR)
    return portable(nuevas.select(*LLAMADA))


def q_carga_dos_veces(spark, d):
    """The calls table after loading the same files twice."""
    destino = carpeta_de_trabajo(spark, "catalogo") + "/llamadas"
    patrones = _escribir(spark, d)
    for _ in range(2):
        ingest.ingerir(spark, destino, files.leer_delimitado(spark, patrones), _programas(spark))
    return portable(spark.read.schema(ingest.TABLA).parquet(destino).select(*LLAMADA))


def q_carga_cuarentena(spark, d):
    """Quarantined rows after loading the files twice: rows of an output name with two programmes."""
    base = carpeta_de_trabajo(spark, "catalogo")
    patrones = _escribir(spark, d)
    for _ in range(2):
        crudo = files.leer_delimitado(spark, patrones)
        ingest.ingerir(spark, f"{base}/llamadas", crudo, _programas(spark), destino_cuarentena=f"{base}/cuarentena")
    malas = spark.read.parquet(f"{base}/cuarentena")
    return malas.groupBy("motivo", "salida", "fecha_txt").agg(F.count(F.lit(1)).alias("filas"))


def q_consolidar_ida_vuelta(spark, d):
    """Exports consolidated into monthly files (K1) and read back with name, month and values."""
    crudo = files.leer_delimitado(spark, _escribir(spark, d))
    destino = carpeta_de_trabajo(spark, "catalogo") + "/cargas"
    sinks.escribir_delimitado(files.carga_mensual(crudo), destino, ("salida", "anio_mes"))
    return files.leer_delimitado(spark, f"{destino}/*/*/*.csv").select(
        "fecha_txt", *files.CAMPOS, "salida", "clave_archivo"
    )


def q_insertar_ignorar_clave(spark, d):
    """K2 with a key that holds no date: (part, supplier)."""
    li = t.tabla(spark, d, "lineitem")
    corte = F.lit("1997-06-01").cast("timestamp_ntz")
    tabla, lote = li.where(F.col("l_shipdate") < corte), li.where(F.col("l_shipdate") >= corte)
    orden = ["l_orderkey", "l_linenumber"]
    return portable(insertar_ignorando(tabla, lote, ["l_partkey", "l_suppkey"], order_cols=orden))


def q_filas_anexadas(spark, d):
    """K3-K5: rows counted by the writes themselves (append, append, replaced month)."""
    base = carpeta_de_trabajo(spark, "catalogo")
    o = t.tabla(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("anio_mes"))
    uno = sinks.anexar(o, f"{base}/t", ["anio_mes"])
    dos = sinks.anexar(o.where("o_orderkey % 2 = 0"), f"{base}/t", ["anio_mes"])
    o = o.withColumn("programa_id", F.lit(1))
    sinks.escribir_delimitado(o, f"{base}/csv")
    sinks.escribir_delimitado(o.where("anio_mes = '1998-01' AND o_orderkey % 2 = 0"), f"{base}/csv")
    csv = spark.read.schema("o_orderkey bigint").option("header", True).option("sep", ";").csv(f"{base}/csv")
    return spark.read.parquet(f"{base}/t").agg(
        F.count(F.lit(1)).alias("en_tabla"), F.lit(uno).cast("bigint").alias("primera"), F.lit(dos).cast("bigint").alias("segunda")
    ).crossJoin(csv.agg(F.count(F.lit(1)).alias("en_archivos")))


REGLAS = [(69, "1998-11", "27"), (820, "1998-11", "83"), (1, "1998-11", "23"), (1414, "1996-02", "71"), (5, "2030-01", "1")]


def _reglas(spark):
    valores = ", ".join(f"({p}, '{m}', '{n}')" for p, m, n in REGLAS)
    return spark.sql(f"SELECT CAST(p AS BIGINT) AS programa_id, m AS anio_mes, n AS log_name FROM VALUES {valores} AS r(p, m, n)")


def _informe_con_reglas(informe, spark, d):
    dims = (t.agentes(spark, d), t.grupos(spark, d), t.programas(spark, d))
    r = informe(t.llamadas(spark, d), *dims, reglas=_reglas(spark))
    return portable(r.withColumn("grupo", F.col("grupo").cast("string")))


def q_dias_con_total_reglas(spark, d):
    """R5 on R2."""
    return _informe_con_reglas(reports.dias_con_total, spark, d)


def q_dias_por_grupo_reglas(spark, d):
    """R5 on R3."""
    return _informe_con_reglas(reports.dias_por_grupo, spark, d)


def q_excluir_agentes(spark, d):
    """Two names excluded, NULL names with them."""
    c = t.llamadas(spark, d).withColumn("log_name", F.nullif("log_name", F.lit("9")))
    return excluir_agentes(c, ["3", "5"]).groupBy("log_name").agg(F.count(F.lit(1)).alias("n"))


def q_programa_por_id(spark, d):
    """One programme by its id, NULL names read as ''."""
    p = programa_por_id(t.programas(spark, d), 7)
    return spark.createDataFrame([tuple(p.values())], ", ".join(f"{k} {'bigint' if k == 'id' else 'string'}" for k in p))


def q_media_ordenada(spark, d):
    """O1: the report's own order, by mean time, then name."""
    r = reports.media_por_agente(t.llamadas_eventos(spark, d), por_programa=False)
    return numerar(r.select("log_name", "media_seg"), ["media_seg", "log_name"])


def q_dias_ordenados(spark, d):
    """O2: the month's report in its own order, totals last in their slice."""
    from .model import Period

    dims = (t.agentes(spark, d), t.grupos(spark, d), t.programas(spark, d))
    r = reports.dias_con_total(t.llamadas(spark, d), *dims, period=Period(1998, 11))
    r = numerar(r.select("programa_id", "fila", "grupo", "log_name"), ["programa_id", "fila", "grupo", "log_name"])
    return r.withColumn("grupo", F.col("grupo").cast("string"))


QUERIES = {
    "carga_exportaciones": q_carga_exportaciones,
    "carga_dos_veces": q_carga_dos_veces,
    "carga_cuarentena": q_carga_cuarentena,
    "consolidar_ida_vuelta": q_consolidar_ida_vuelta,
    "insertar_ignorar_clave": q_insertar_ignorar_clave,
    "filas_anexadas": q_filas_anexadas,
    "dias_con_total_reglas": q_dias_con_total_reglas,
    "dias_por_grupo_reglas": q_dias_por_grupo_reglas,
    "excluir_agentes": q_excluir_agentes,
    "programa_por_id": q_programa_por_id,
    "media_ordenada": q_media_ordenada,
    "dias_ordenados": q_dias_ordenados,
}

_ESTACION = "CASE WHEN l_partkey % 5 = 0 THEN 'A;\"' || l_returnflag || '\" ' ELSE l_returnflag END"
_LLAMANTE = "CASE WHEN l_orderkey % 7 = 0 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END"
_AGENTE = "CASE WHEN l_suppkey % 11 = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END"

_LEIDAS = f"""leidas AS (
    SELECT CAST(l_shipdate AS DATE) AS f, printf('%02d:%02d:%02d', l_linenumber + 8, l_partkey % 60, l_suppkey % 60) AS hora,
           {_LLAMANTE} AS llamante, CAST(trunc(round(l_extendedprice, 2)) AS INTEGER) AS dur, {_ESTACION} AS station,
           l_linestatus AS voice_file, {_AGENTE} AS log_name, '{RESULTADO}' AS resultado,
           CAST(l_partkey % 3 + 1 AS INTEGER) AS programa_id, l_shipdate,
           row_number() OVER (
             PARTITION BY CAST(l_shipdate AS DATE), l_linenumber, l_partkey % 60, l_suppkey % 60, {_LLAMANTE}, {_AGENTE}, l_partkey % 3
             ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_shipdate, l_quantity) AS rn
    FROM lineitem WHERE l_partkey % 3 <> 2
  )"""
_CAMPOS_LLAMADA = (
    "strftime(f, '%Y-%m-%d') AS fecha, hora, llamante, dur, station, voice_file, log_name, resultado, programa_id"
)

_REGLAS_SQL = f"""reglas(programa_id, anio_mes, log_name) AS (
    VALUES {", ".join(f"({p}, '{m}', '{n}')" for p, m, n in REGLAS)}
  ),
  calls AS (
    SELECT * FROM (SELECT CAST(l_shipdate AS DATE) AS fecha, CAST(l_suppkey AS VARCHAR) AS log_name, l_partkey AS programa_id
                   FROM lineitem) c
    WHERE NOT EXISTS (
      SELECT 1 FROM reglas r
      WHERE r.programa_id = c.programa_id AND r.anio_mes = strftime(c.fecha, '%Y-%m')
        AND (r.log_name = c.log_name OR c.log_name IS NULL))
  )"""


def oraculos(bloques: dict[str, str]) -> dict[str, str]:
    """The DuckDB oracles. ``bloques``: the report blocks (per_agent, det, r2, r3) the catalog shares."""
    return {
        "carga_exportaciones": f"""
WITH {_LEIDAS}
SELECT {_CAMPOS_LLAMADA} FROM leidas l
WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM leidas s WHERE s.l_shipdate < TIMESTAMP '{CORTE}' AND s.f = l.f AND s.hora = l.hora
    AND s.llamante = l.llamante AND s.log_name = l.log_name AND s.programa_id = l.programa_id)
""",
        "carga_dos_veces": f"WITH {_LEIDAS} SELECT {_CAMPOS_LLAMADA} FROM leidas WHERE rn = 1",
        "carga_cuarentena": """
SELECT 'programa_ambiguo' AS motivo, 'S2' AS salida,
       printf('%d/%d/%d', day(l_shipdate), month(l_shipdate), year(l_shipdate)) AS fecha_txt, count(*) AS filas
FROM lineitem WHERE l_partkey % 3 = 2 GROUP BY 3
""",
        "consolidar_ida_vuelta": f"""
SELECT printf('%d/%d/%d', day(l_shipdate), month(l_shipdate), year(l_shipdate)) AS fecha_txt,
       printf('%d:%02d:%02d', l_linenumber + 8, l_partkey % 60, l_suppkey % 60) AS hora_txt,
       {_LLAMANTE} AS llamante, replace(printf('%.2f', l_extendedprice), '.', ',') AS dur_txt, {_ESTACION} AS station,
       l_linestatus AS voice_file, {_AGENTE} AS log_name, '{RESULTADO}' AS resultado,
       'S' || CAST(l_partkey % 3 AS VARCHAR) AS salida, strftime(l_shipdate, '%Y%m') AS clave_archivo
FROM lineitem
""",
        "insertar_ignorar_clave": """
WITH ranked AS (
    SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
      ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-06-01'
  )
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM ranked r
WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '1997-06-01' AND t.l_partkey = r.l_partkey AND t.l_suppkey = r.l_suppkey)
""",
        "filas_anexadas": """
SELECT CAST(count(*) + count(*) FILTER (o_orderkey % 2 = 0) AS BIGINT) AS en_tabla, count(*) AS primera,
       count(*) FILTER (o_orderkey % 2 = 0) AS segunda,
       count(*) FILTER (o_orderkey % 2 = 0 OR strftime(o_orderdate, '%Y-%m') <> '1998-01') AS en_archivos
FROM orders
""",
        "dias_con_total_reglas": f"WITH {_REGLAS_SQL}, {bloques['per_agent']}, {bloques['det']}\n{bloques['r2']}",
        "dias_por_grupo_reglas": f"WITH {_REGLAS_SQL}, {bloques['per_agent']}, {bloques['det']}\n{bloques['r3']}",
        "excluir_agentes": """
SELECT CAST(l_suppkey AS VARCHAR) AS log_name, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (3, 5, 9) GROUP BY 1
""",
        "programa_por_id": """
SELECT p_partkey AS id, p_brand AS nombre_monitor, CASE WHEN p_type = 'STANDARD' THEN '' ELSE coalesce(p_type, '') END AS nombre_salida,
       CASE WHEN p_brand = 'Brand#4' THEN '' ELSE coalesce(p_brand, '') END AS directorio
FROM part WHERE p_partkey = 7
""",
        "media_ordenada": """
SELECT log_name, m AS media_seg, row_number() OVER (ORDER BY m NULLS FIRST, log_name NULLS FIRST) AS posicion
FROM (SELECT user_id AS log_name, CAST(sum(CAST(floor(value) AS INTEGER)) // count(value) AS BIGINT) AS m FROM events GROUP BY 1) x
""",
        "dias_ordenados": f"""
WITH {bloques['calls']}, {bloques['per_agent']}, {bloques['det']},
  filas AS (
    SELECT programa_id, 'D' AS fila, grupo, log_name FROM det WHERE anio = 1998 AND mes = 11
    UNION ALL
    SELECT programa_id, 'T', NULL, NULL FROM tot WHERE anio = 1998 AND mes = 11
  )
SELECT programa_id, fila, CAST(grupo AS VARCHAR) AS grupo, log_name,
       row_number() OVER (ORDER BY programa_id, fila, grupo NULLS FIRST, log_name NULLS FIRST) AS posicion
FROM filas
""",
    }
