"""Registered queries over the generated tables, and their DuckDB oracles.

Every query reads whole tables through the stand-in mapping in
``sources.tables``; outputs pass through ``present.portable`` so decimals,
dates and timestamps compare equal across client libraries.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog_load, catalog_slices
from .functions import normalize as N
from .functions.present import dinero_es, portable, presentar, texto
from .model import Period
from .operators.filters import activos
from .operators.load import insertar_ignorando
from .operators.setops import union_distinta, unir_por_nombre
from .plans import attendance, coverage, reports
from .sources import tables as t

# Month used by the single-month variants (non-empty at every scale of the generated data).
MES = Period(1998, 11)
# Month covered by the events table.
MES_EVENTOS = Period(2024, 1)
# Exclusion rules for R5: (programa_id, anio_mes, log_name); the last one matches no call.
REGLAS = [
    (69, "1998-11", "27"),
    (820, "1998-11", "83"),
    (1, "1998-11", "23"),
    (1414, "1996-02", "71"),
    (5, "2030-01", "1"),
]
# Split instant of the insert-ignore case: earlier rows are the table, the rest the batch.
CORTE = "1998-01-01"
# Day and programme of the one-day attendance case.
DIA_ASISTENCIA = "1998-11-05"
PROGRAMA_ASISTENCIA = 7


def _reglas(spark: SparkSession) -> DataFrame:
    valores = ", ".join(f"({p}, '{m}', '{n}')" for p, m, n in REGLAS)
    return spark.sql(
        "SELECT CAST(programa_id AS BIGINT) AS programa_id, anio_mes, log_name "
        f"FROM VALUES {valores} AS reglas(programa_id, anio_mes, log_name)"
    )


def q_dias_por_agente(spark, d):
    return portable(reports.dias_por_agente(t.llamadas(spark, d)))


def q_dias_por_agente_mes(spark, d):
    return portable(reports.dias_por_agente(t.llamadas(spark, d), period=MES))


def _grupo_texto(df: DataFrame, programa: bool = False) -> DataFrame:
    # Total rows carry a NULL group (and, when global over several programmes, a
    # NULL programme); as text they survive pandas conversion unchanged.
    df = df.withColumn("grupo", F.col("grupo").cast("string"))
    return df.withColumn("programa_id", F.col("programa_id").cast("string")) if programa else df


def q_dias_con_total(spark, d):
    r = reports.dias_con_total(t.llamadas(spark, d), t.agentes(spark, d), t.grupos(spark, d), t.programas(spark, d))
    return portable(_grupo_texto(r))


def q_dias_por_grupo(spark, d):
    r = reports.dias_por_grupo(t.llamadas(spark, d), t.agentes(spark, d), t.grupos(spark, d), t.programas(spark, d))
    return portable(_grupo_texto(r))


def q_informe_presentado(spark, d):
    r = reports.dias_con_total(t.llamadas(spark, d), t.agentes(spark, d), t.grupos(spark, d), t.programas(spark, d))
    return portable(_grupo_texto(presentar(r)))


def q_dias_trabajados_mes(spark, d):
    # days each agent worked in any programme during the month
    return portable(reports.dias_por_agente(t.llamadas(spark, d), period=MES, por_programa=False))


def q_dias_con_total_mes(spark, d):
    # the month's report over every programme with one total row (NULL rate: several programmes)
    r = reports.dias_con_total(
        t.llamadas(spark, d), t.agentes(spark, d), t.grupos(spark, d), t.programas(spark, d), period=MES, total="global"
    )
    return portable(_grupo_texto(r, programa=True))


def q_dias_por_grupo_mes(spark, d):
    r = reports.dias_por_grupo(
        t.llamadas(spark, d), t.agentes(spark, d), t.grupos(spark, d), t.programas(spark, d), period=MES, total="global"
    )
    return portable(_grupo_texto(r, programa=True))


def q_dias_con_reglas_mes(spark, d):
    # rules that hold in every programme (NULL programme): agents 5 and 7 in 1998-11, 9 in 1998-10
    reglas = spark.sql(
        "SELECT CAST(NULL AS BIGINT) AS programa_id, anio_mes, log_name "
        "FROM VALUES ('1998-11', '5'), ('1998-11', '7'), ('1998-10', '9') AS r(anio_mes, log_name)"
    )
    return portable(reports.dias_por_agente(t.llamadas(spark, d), period=MES, por_programa=False, reglas=reglas))


def q_dias_con_reglas(spark, d):
    return portable(reports.dias_por_agente(t.llamadas(spark, d), reglas=_reglas(spark)))


def q_media_por_agente(spark, d):
    return portable(reports.media_por_agente(t.llamadas_eventos(spark, d)))


def q_media_por_agente_serie(spark, d):
    return portable(reports.media_por_agente(t.llamadas_eventos(spark, d), por_programa=False))


def q_media_por_agente_mes(spark, d):
    return portable(
        reports.media_por_agente(t.llamadas_eventos(spark, d), period=MES_EVENTOS, programa="click", mensual=True)
    )


def q_insertar_ignorar(spark, d):
    li = t.tabla(spark, d, "lineitem")
    corte = F.lit(CORTE).cast("timestamp_ntz")
    tabla, lote = li.where(F.col("l_shipdate") < corte), li.where(F.col("l_shipdate") >= corte)
    return portable(insertar_ignorando(tabla, lote, ["l_orderkey", "l_linenumber"]))


def q_asistencia(spark, d):
    # Presences: each line's agent and programme on its order day; filled where
    # that agent has no call for that programme on that day.
    li = t.tabla(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders = t.tabla(spark, d, "orders").select("o_orderkey", "o_orderdate")
    presencias = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderdate").cast("date").alias("fecha"),
        F.col("l_partkey").alias("programa_id"),
        F.col("l_suppkey").cast("string").alias("log_name"),
    )
    out = attendance.asistencia(t.llamadas(spark, d), t.agentes(spark, d), t.programas(spark, d), presencias)
    return portable(out)


def q_asistencia_dia(spark, d):
    # The reference's form: one day and one programme; every agent idle that day
    # (no call in any programme) gets a placeholder row.
    ag = t.agentes(spark, d)
    return portable(
        attendance.asistencia(
            t.llamadas(spark, d),
            ag,
            t.programas(spark, d),
            ag.select(
                F.lit(DIA_ASISTENCIA).cast("date").alias("fecha"),
                F.lit(PROGRAMA_ASISTENCIA).cast("bigint").alias("programa_id"),
                "log_name",
            ),
            ventana=(dt.date.fromisoformat(DIA_ASISTENCIA),) * 2,
            en_cualquier_programa=True,
        )
    )


def _marcas(spark, d):
    """Programmes = part brands; days received = brand-days with a lineitem row."""
    part = t.tabla(spark, d, "part").select("p_partkey", "p_brand")
    progs = part.groupBy("p_brand").agg(F.lit(1).alias("activo")).select(
        F.col("p_brand").alias("id"), F.col("p_brand").alias("nombre_monitor"), "activo"
    )
    li = t.tabla(spark, d, "lineitem").select("l_partkey", "l_shipdate")
    recibidos = li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("p_brand").alias("programa_id"), F.col("l_shipdate").cast("date").alias("fecha")
    )
    return progs, recibidos


def q_cobertura(spark, d):
    progs, recibidos = _marcas(spark, d)
    return portable(coverage.cobertura(recibidos, progs))


def q_cobertura_mes(spark, d):
    progs, recibidos = _marcas(spark, d)
    return portable(coverage.cobertura(recibidos, progs, period=MES))


def q_cobertura_etiquetas(spark, d):
    # Listing texts: one per brand and day with calls, 'Emisión <brand> - <day> (<n> llamadas)';
    # expected labels: every brand on every day of the month.
    progs, _ = _marcas(spark, d)
    part = t.tabla(spark, d, "part").select("p_partkey", "p_brand")
    li = t.tabla(spark, d, "lineitem").select("l_partkey", "l_shipdate")
    por_dia = (
        li.join(part, li.l_partkey == part.p_partkey)
        .groupBy("p_brand", F.col("l_shipdate").cast("date").alias("dia"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    opciones = por_dia.select(
        F.format_string(
            "Emisión%s%s - %s (%d llamadas)",
            F.when(F.col("n") % 2 == 0, "\n").otherwise(" "),
            "p_brand",
            F.date_format("dia", "yyyy-MM-dd"),
            "n",
        ).alias("texto")
    )
    return portable(coverage.cobertura_etiquetas(opciones, progs, period=MES))


def q_normalizar_fecha(spark, d):
    o = t.tabla(spark, d, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey") % 4
    txt = (
        F.when(k == 0, F.date_format("o_orderdate", "d/M/yyyy"))
        .when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(k == 2, F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("o_orderdate", "d/M/yyyy H:mm:ss"))
    )
    return portable(o.select("o_orderkey", N.fecha(txt).alias("fecha")))


def q_normalizar_hora(spark, d):
    e = t.tabla(spark, d, "events").select("event_id", "ts")
    k = F.col("event_id") % 3
    txt = (
        F.when(k == 0, F.date_format("ts", "H:mm:ss"))
        .when(k == 1, F.date_format("ts", "HH:mm:ss"))
        .otherwise(F.date_format("ts", "30/12/1899 H:mm:ss"))
    )
    return e.select("event_id", N.hora(txt).alias("hora"))


def q_normalizar_dur(spark, d):
    e = t.tabla(spark, d, "events").select("event_id", "value")
    txt = F.regexp_replace(F.format_string("%.2f", "value"), r"\.", ",")
    return e.select("event_id", N.duracion(txt).alias("dur"))


def q_cuarentena(spark, d):
    # Every event rendered as export text; some renderings cannot be read:
    # minute + 60 when event_id % 11 = 0, a dot decimal when event_id % 13 = 0,
    # day 31 of its month when event_id % 17 = 0 (impossible in shorter months).
    e = t.tabla(spark, d, "events").select("event_id", "ts", "value", "user_id")
    i = F.col("event_id")
    dia = F.when(i % 17 == 0, F.format_string("31/%d/%d", F.month("ts"), F.year("ts"))).otherwise(
        F.date_format("ts", "d/M/yyyy H:mm:ss")
    )
    hora = F.when(i % 11 == 0, F.format_string("%d:%d:%d", F.hour("ts"), F.minute("ts") + 60, F.second("ts"))).otherwise(
        F.date_format("ts", "30/12/1899 H:mm:ss")
    )
    dur = F.format_string("%.2f", "value")
    dur = F.when(i % 13 == 0, dur).otherwise(F.regexp_replace(dur, r"\.", ","))
    raw = e.select(
        "event_id",
        dia.alias("fecha_txt"),
        hora.alias("hora_txt"),
        dur.alias("dur_txt"),
        F.col("user_id").cast("string").alias("log_name"),
    )
    out = N.normalizar(raw).select("event_id", "fecha", "hora", "dur", "motivo")
    # dur is NULL on quarantined rows; as text it survives pandas conversion unchanged
    return portable(out.withColumn("dur", F.col("dur").cast("string")))


def q_dias_del_mes(spark, d):
    o = t.tabla(spark, d, "orders").select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("d")).distinct()
    return o.select(
        F.date_format("d", "yyyy-MM").alias("anio_mes"),
        N.dias_del_mes("d").alias("dias"),
        N.clave_dia("d").alias("primer_dia"),
        N.clave_dia_compacta(F.last_day("d")).alias("ultimo_dia"),
        N.dos_cifras(F.month("d")).alias("mm"),
    )


def q_union_distinta(spark, d):
    a = t.tabla(spark, d, "supplier").select(F.col("s_nationkey").alias("grupo"))
    b = t.tabla(spark, d, "nation").select(F.col("n_nationkey").alias("grupo"))
    return union_distinta(a, b)


def q_concat_esquemas(spark, d):
    p = t.tabla(spark, d, "part")
    a = p.where(F.col("p_size") <= 25).select("p_partkey", "p_name", F.col("p_size").alias("CC"), "p_brand")
    b = p.where(F.col("p_size") > 25).select("p_partkey", "p_brand", "p_type")
    return unir_por_nombre([a, b], drop=["CC"])


def q_programas_activos(spark, d):
    p = activos(t.programas(spark, d))
    return p.select(
        "id",
        "nombre_excel",
        "nombre_monitor",
        N.vacio_si_nulo("nombre_salida").alias("nombre_salida"),
        N.vacio_si_nulo("directorio").alias("directorio"),
    )


def q_agentes_activos(spark, d):
    return activos(t.agentes(spark, d)).select("log_name")


def q_importe_formateado(spark, d):
    p = t.programas(spark, d)
    x = (F.col("factura_hora") * F.lit(12.345).cast("decimal(5,3)"))
    return p.select("id", texto(F.col("id")).alias("id_txt"), dinero_es(x).alias("importe_txt"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dias_por_agente": q_dias_por_agente,
    "dias_por_agente_mes": q_dias_por_agente_mes,
    "dias_con_total": q_dias_con_total,
    "dias_por_grupo": q_dias_por_grupo,
    "dias_trabajados_mes": q_dias_trabajados_mes,
    "dias_con_total_mes": q_dias_con_total_mes,
    "dias_por_grupo_mes": q_dias_por_grupo_mes,
    "dias_con_reglas": q_dias_con_reglas,
    "dias_con_reglas_mes": q_dias_con_reglas_mes,
    "informe_presentado": q_informe_presentado,
    "media_por_agente": q_media_por_agente,
    "media_por_agente_serie": q_media_por_agente_serie,
    "media_por_agente_mes": q_media_por_agente_mes,
    "insertar_ignorar": q_insertar_ignorar,
    "asistencia": q_asistencia,
    "asistencia_dia": q_asistencia_dia,
    "cobertura": q_cobertura,
    "cobertura_mes": q_cobertura_mes,
    "cobertura_etiquetas": q_cobertura_etiquetas,
    "normalizar_fecha": q_normalizar_fecha,
    "normalizar_hora": q_normalizar_hora,
    "normalizar_dur": q_normalizar_dur,
    "cuarentena": q_cuarentena,
    "dias_del_mes": q_dias_del_mes,
    "union_distinta": q_union_distinta,
    "concat_esquemas": q_concat_esquemas,
    "programas_activos": q_programas_activos,
    "agentes_activos": q_agentes_activos,
    "importe_formateado": q_importe_formateado,
}

# ---------------------------------------------------------------------------
# DuckDB oracles. Same stand-in mapping, written independently as plain SQL.

_CALLS = """calls AS (
    SELECT CAST(l_shipdate AS DATE) AS fecha, CAST(l_suppkey AS VARCHAR) AS log_name, l_partkey AS programa_id
    FROM lineitem
  )"""

_PER_AGENT = """per_agent AS (
    SELECT programa_id, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
           log_name, count(fecha) AS n_dias
    FROM (SELECT DISTINCT programa_id, log_name, fecha FROM calls) d
    GROUP BY 1, 2, 3, 4
  )"""

_DET = """det AS (
    SELECT p.programa_id, p.anio, p.mes, a.s_nationkey AS grupo, g.n_name AS grupo_desc,
           p.log_name, a.s_name AS nombre, pr.p_brand AS nombre_monitor,
           CAST(pr.p_retailprice AS DECIMAL(10,2)) AS tarifa, p.n_dias,
           CAST(p.n_dias * CAST(pr.p_retailprice AS DECIMAL(10,2)) AS DECIMAL(18,2)) AS importe
    FROM per_agent p
    JOIN supplier a ON CAST(a.s_suppkey AS VARCHAR) = p.log_name
    JOIN nation g ON g.n_nationkey = a.s_nationkey
    JOIN part pr ON pr.p_partkey = p.programa_id
  ),
  tot AS (
    SELECT programa_id, anio, mes, max(nombre_monitor) AS nombre_monitor, max(tarifa) AS tarifa,
           CAST(sum(n_dias) AS BIGINT) AS n_dias, CAST(sum(importe) AS DECIMAL(18,2)) AS importe
    FROM det GROUP BY 1, 2, 3
  )"""

_EV = """ev AS (
    SELECT CAST(ts AS DATE) AS fecha, user_id AS log_name, event_type AS programa_id,
           CAST(floor(value) AS INTEGER) AS dur
    FROM events
  )"""

_ES = "translate(format('{{:,.2f}}', {x}), ',.', '.,')"

_HHMMSS = "printf('%02d:%02d:%02d', m // 3600, (m // 60) % 60, m % 60)"

_LI_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

_MARCAS = """recibidos AS (
    SELECT DISTINCT p.p_brand AS programa_id, CAST(l.l_shipdate AS DATE) AS fecha
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  )"""

ORACLE: dict[str, str] = {
    "dias_por_agente": f"""
WITH {_CALLS}, {_PER_AGENT}
SELECT * FROM per_agent
""",
    "dias_por_agente_mes": f"""
WITH {_CALLS}, {_PER_AGENT}
SELECT * FROM per_agent WHERE anio = 1998 AND mes = 11
""",
    "dias_con_total": f"""
WITH {_CALLS}, {_PER_AGENT}, {_DET}
SELECT programa_id, anio, mes, 'D' AS fila, CAST(grupo AS VARCHAR) AS grupo, log_name, nombre, nombre_monitor,
       CAST(tarifa AS DOUBLE) AS tarifa, CAST(n_dias AS BIGINT) AS n_dias, CAST(importe AS DOUBLE) AS importe
FROM det
UNION ALL
SELECT programa_id, anio, mes, 'T', NULL, NULL, NULL, nombre_monitor,
       CAST(tarifa AS DOUBLE), n_dias, CAST(importe AS DOUBLE)
FROM tot
""",
    "dias_por_grupo": f"""
WITH {_CALLS}, {_PER_AGENT}, {_DET}
SELECT programa_id, anio, mes, 'D' AS fila, CAST(grupo AS VARCHAR) AS grupo, grupo_desc, nombre_monitor,
       CAST(tarifa AS DOUBLE) AS tarifa, n_dias,
       CAST(CAST(n_dias * tarifa AS DECIMAL(18,2)) AS DOUBLE) AS importe
FROM (
  SELECT d.programa_id, d.anio, d.mes, d.grupo, max(d.grupo_desc) AS grupo_desc,
         max(d.nombre_monitor) AS nombre_monitor, max(d.tarifa) AS tarifa,
         CAST(count(DISTINCT (c.log_name, c.fecha)) AS BIGINT) AS n_dias
  FROM det d
  JOIN calls c ON c.programa_id = d.programa_id AND c.log_name = d.log_name
   AND year(c.fecha) = d.anio AND month(c.fecha) = d.mes
  WHERE c.log_name IS NOT NULL AND c.fecha IS NOT NULL
  GROUP BY 1, 2, 3, 4
) g
UNION ALL
SELECT programa_id, anio, mes, 'T', NULL, NULL, nombre_monitor,
       CAST(tarifa AS DOUBLE), n_dias, CAST(importe AS DOUBLE)
FROM tot
""",
    "dias_trabajados_mes": f"""
WITH {_CALLS}
SELECT CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes, log_name,
       count(fecha) AS n_dias
FROM (SELECT DISTINCT log_name, fecha FROM calls
      WHERE fecha >= DATE '1998-11-01' AND fecha < DATE '1998-12-01') d
GROUP BY 1, 2, 3
""",
    "dias_con_total_mes": f"""
WITH {_CALLS}, {_PER_AGENT}, {_DET},
  m AS (SELECT * FROM det WHERE anio = 1998 AND mes = 11)
SELECT CAST(programa_id AS VARCHAR) AS programa_id, anio, mes, 'D' AS fila, CAST(grupo AS VARCHAR) AS grupo, log_name, nombre, nombre_monitor,
       CAST(tarifa AS DOUBLE) AS tarifa, CAST(n_dias AS BIGINT) AS n_dias, CAST(importe AS DOUBLE) AS importe
FROM m
UNION ALL
SELECT CAST(CASE WHEN min(programa_id) = max(programa_id) THEN min(programa_id) END AS VARCHAR),
       CASE WHEN min(anio) = max(anio) THEN min(anio) END,
       CASE WHEN min(mes) = max(mes) THEN min(mes) END,
       'T', NULL, NULL, NULL,
       CASE WHEN min(programa_id) = max(programa_id) THEN min(nombre_monitor) END,
       CAST(CASE WHEN min(programa_id) = max(programa_id) THEN min(tarifa) END AS DOUBLE),
       CAST(sum(n_dias) AS BIGINT), CAST(CAST(sum(importe) AS DECIMAL(18,2)) AS DOUBLE)
FROM m
""",
    "dias_por_grupo_mes": f"""
WITH {_CALLS}, {_PER_AGENT}, {_DET},
  m AS (SELECT * FROM det WHERE anio = 1998 AND mes = 11)
SELECT CAST(programa_id AS VARCHAR) AS programa_id, anio, mes, 'D' AS fila, CAST(grupo AS VARCHAR) AS grupo, max(grupo_desc) AS grupo_desc,
       max(nombre_monitor) AS nombre_monitor, CAST(max(tarifa) AS DOUBLE) AS tarifa,
       CAST(sum(n_dias) AS BIGINT) AS n_dias,
       CAST(CAST(sum(n_dias) * max(tarifa) AS DECIMAL(18,2)) AS DOUBLE) AS importe
FROM m GROUP BY m.programa_id, anio, mes, grupo
UNION ALL
SELECT CAST(CASE WHEN min(programa_id) = max(programa_id) THEN min(programa_id) END AS VARCHAR),
       CASE WHEN min(anio) = max(anio) THEN min(anio) END,
       CASE WHEN min(mes) = max(mes) THEN min(mes) END,
       'T', NULL, NULL,
       CASE WHEN min(programa_id) = max(programa_id) THEN min(nombre_monitor) END,
       CAST(CASE WHEN min(programa_id) = max(programa_id) THEN min(tarifa) END AS DOUBLE),
       CAST(sum(n_dias) AS BIGINT), CAST(CAST(sum(importe) AS DECIMAL(18,2)) AS DOUBLE)
FROM m
""",
    "informe_presentado": f"""
WITH {_CALLS}, {_PER_AGENT}, {_DET}
SELECT programa_id, anio, mes, 'D' AS fila, CAST(grupo AS VARCHAR) AS grupo, log_name, nombre, nombre_monitor,
       {_ES.format(x="tarifa")} AS tarifa, CAST(n_dias AS VARCHAR) AS n_dias, {_ES.format(x="importe")} AS importe
FROM det
UNION ALL
SELECT programa_id, anio, mes, 'T', NULL, '-----', '-----', '-TOTAL:-->',
       {_ES.format(x="tarifa")}, CAST(n_dias AS VARCHAR), {_ES.format(x="importe")}
FROM tot
""",
    "dias_con_reglas": f"""
WITH {_CALLS},
  reglas(programa_id, anio_mes, log_name) AS (
    VALUES {", ".join(f"({p}, '{m}', '{n}')" for p, m, n in REGLAS)}
  ),
  filtradas AS (
    SELECT c.* FROM calls c
    WHERE NOT EXISTS (
      SELECT 1 FROM reglas r
      WHERE r.programa_id = c.programa_id AND r.anio_mes = strftime(c.fecha, '%Y-%m')
        AND (r.log_name = c.log_name OR c.log_name IS NULL)
    )
  )
SELECT programa_id, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
       log_name, count(fecha) AS n_dias
FROM (SELECT DISTINCT programa_id, log_name, fecha FROM filtradas) d
GROUP BY 1, 2, 3, 4
""",
    "dias_con_reglas_mes": f"""
WITH {_CALLS}
SELECT CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes, log_name,
       count(fecha) AS n_dias
FROM (SELECT DISTINCT log_name, fecha FROM calls c
      WHERE fecha >= DATE '1998-11-01' AND fecha < DATE '1998-12-01'
        AND NOT EXISTS (
          SELECT 1 FROM (VALUES ('1998-11', '5'), ('1998-11', '7'), ('1998-10', '9')) r(anio_mes, log_name)
          WHERE r.anio_mes = strftime(c.fecha, '%Y-%m') AND (r.log_name = c.log_name OR c.log_name IS NULL))) d
GROUP BY 1, 2, 3
""",
    "media_por_agente": f"""
WITH {_EV}
SELECT programa_id, log_name, {_HHMMSS} AS dur_media, m AS media_seg, tot_sec, num_llamadas
FROM (
  SELECT programa_id, log_name, CAST(sum(dur) AS BIGINT) AS tot_sec,
         CAST(sum(dur) // count(dur) AS BIGINT) AS m, count(*) AS num_llamadas
  FROM ev GROUP BY 1, 2
) x
""",
    "media_por_agente_serie": f"""
WITH {_EV}
SELECT log_name, {_HHMMSS} AS dur_media, m AS media_seg, tot_sec, num_llamadas
FROM (
  SELECT log_name, CAST(sum(dur) AS BIGINT) AS tot_sec,
         CAST(sum(dur) // count(dur) AS BIGINT) AS m, count(*) AS num_llamadas
  FROM ev GROUP BY 1
) x
""",
    "media_por_agente_mes": f"""
WITH {_EV}
SELECT programa_id, anio, mes, log_name, {_HHMMSS} AS dur_media, m AS media_seg, tot_sec, num_llamadas
FROM (
  SELECT programa_id, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
         log_name, CAST(sum(dur) AS BIGINT) AS tot_sec,
         CAST(sum(dur) // count(dur) AS BIGINT) AS m, count(*) AS num_llamadas
  FROM ev
  WHERE fecha >= DATE '2024-01-01' AND fecha < DATE '2024-02-01' AND programa_id = 'click'
  GROUP BY 1, 2, 3, 4
) x
""",
    "insertar_ignorar": f"""
WITH lote AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CORTE}'),
  tabla AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate < TIMESTAMP '{CORTE}'),
  ranked AS (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
               l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
               l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
    FROM lote
  )
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM ranked r
WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM tabla t WHERE t.l_orderkey = r.l_orderkey AND t.l_linenumber = r.l_linenumber)
""",
    "asistencia": """
WITH pres AS (
    SELECT DISTINCT CAST(o.o_orderdate AS DATE) AS fecha, l.l_partkey AS programa_id,
           CAST(l.l_suppkey AS VARCHAR) AS log_name
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  )
SELECT strftime(p.fecha, '%Y-%m-%d') AS fecha, printf('%02d:00:00', pr.p_size % 24) AS hora,
       '34000000000' AS llamante, 0 AS dur, CAST(NULL AS VARCHAR) AS station,
       CAST(NULL AS VARCHAR) AS voice_file, p.log_name,
       'Request for information without order' AS resultado, p.programa_id
FROM pres p
JOIN part pr ON pr.p_partkey = p.programa_id
WHERE p.log_name IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)
  AND NOT EXISTS (
    SELECT 1 FROM lineitem c
    WHERE CAST(c.l_shipdate AS DATE) = p.fecha AND c.l_partkey = p.programa_id
      AND CAST(c.l_suppkey AS VARCHAR) = p.log_name)
""",
    "asistencia_dia": """
SELECT '1998-11-05' AS fecha, printf('%02d:00:00', pr.p_size % 24) AS hora,
       '34000000000' AS llamante, 0 AS dur, CAST(NULL AS VARCHAR) AS station,
       CAST(NULL AS VARCHAR) AS voice_file, CAST(s.s_suppkey AS VARCHAR) AS log_name,
       'Request for information without order' AS resultado, pr.p_partkey AS programa_id
FROM supplier s JOIN part pr ON pr.p_partkey = 7
WHERE NOT EXISTS (
  SELECT 1 FROM lineitem c
  WHERE CAST(c.l_shipdate AS DATE) = DATE '1998-11-05' AND c.l_suppkey = s.s_suppkey)
""",
    "cobertura": f"""
WITH {_MARCAS},
  b AS (SELECT programa_id, date_trunc('month', min(fecha)) AS d0, last_day(max(fecha)) AS d1
        FROM recibidos GROUP BY 1),
  esperado AS (
    SELECT programa_id, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS fecha FROM b
  )
SELECT e.programa_id, strftime(e.fecha, '%Y-%m-%d') AS fecha, e.programa_id || ' - ' || strftime(e.fecha, '%Y-%m-%d') AS etiqueta
FROM esperado e
WHERE NOT EXISTS (SELECT 1 FROM recibidos r WHERE r.programa_id = e.programa_id AND r.fecha = e.fecha)
""",
    "cobertura_mes": f"""
WITH {_MARCAS},
  esperado AS (
    SELECT m.p_brand AS programa_id, CAST(d AS DATE) AS fecha
    FROM (SELECT DISTINCT p_brand FROM part) m,
         unnest(generate_series(TIMESTAMP '1998-11-01', TIMESTAMP '1998-11-30', INTERVAL 1 DAY)) AS s(d)
  )
SELECT e.programa_id, strftime(e.fecha, '%Y-%m-%d') AS fecha, e.programa_id || ' - ' || strftime(e.fecha, '%Y-%m-%d') AS etiqueta
FROM esperado e
WHERE NOT EXISTS (SELECT 1 FROM recibidos r WHERE r.programa_id = e.programa_id AND r.fecha = e.fecha)
""",
    "cobertura_etiquetas": """
WITH op AS (
    SELECT 'Emisión' || CASE WHEN count(*) % 2 = 0 THEN chr(10) ELSE ' ' END || p.p_brand || ' - ' || strftime(CAST(l.l_shipdate AS DATE), '%Y-%m-%d')
           || ' (' || CAST(count(*) AS VARCHAR) || ' llamadas)' AS texto
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
    GROUP BY p.p_brand, CAST(l.l_shipdate AS DATE)
  ),
  esperado AS (
    SELECT m.p_brand AS programa_id, CAST(d AS DATE) AS fecha,
           m.p_brand || ' - ' || strftime(CAST(d AS DATE), '%Y-%m-%d') AS etiqueta
    FROM (SELECT DISTINCT p_brand FROM part) m,
         unnest(generate_series(TIMESTAMP '1998-11-01', TIMESTAMP '1998-11-30', INTERVAL 1 DAY)) AS s(d)
  )
SELECT e.programa_id, strftime(e.fecha, '%Y-%m-%d') AS fecha, e.etiqueta
FROM esperado e
WHERE NOT EXISTS (SELECT 1 FROM op WHERE contains(op.texto, e.etiqueta))
""",
    "normalizar_fecha": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS fecha FROM orders
""",
    "normalizar_hora": """
SELECT event_id, strftime(ts, '%H:%M:%S') AS hora FROM events
""",
    "normalizar_dur": """
SELECT event_id, CAST(trunc(round(value, 2)) AS INTEGER) AS dur FROM events
""",
    "cuarentena": """
WITH x AS (
  SELECT event_id,
         CASE WHEN event_id % 17 = 0
              THEN CASE WHEN day(last_day(ts)) = 31 THEN make_date(year(ts), month(ts), 31) END
              ELSE CAST(ts AS DATE) END AS f,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE strftime(ts, '%H:%M:%S') END AS hora,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(trunc(round(value, 2)) AS INTEGER) END AS dur
  FROM events
)
SELECT event_id, strftime(f, '%Y-%m-%d') AS fecha, hora, CAST(dur AS VARCHAR) AS dur,
       NULLIF(concat_ws(',', CASE WHEN f IS NULL THEN 'fecha' END, CASE WHEN hora IS NULL THEN 'hora' END,
                        CASE WHEN dur IS NULL THEN 'dur' END), '') AS motivo
FROM x
""",
    "dias_del_mes": """
SELECT strftime(d, '%Y-%m') AS anio_mes, CAST(day(last_day(d)) AS INTEGER) AS dias,
       strftime(d, '%Y-%m-%d') AS primer_dia, strftime(last_day(d), '%Y%m%d') AS ultimo_dia,
       printf('%02d', month(d)) AS mm
FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders) x
""",
    "union_distinta": """
SELECT s_nationkey AS grupo FROM supplier UNION SELECT n_nationkey FROM nation
""",
    "concat_esquemas": """
SELECT p_partkey, p_name, p_brand, p_type FROM (
  SELECT p_partkey, p_name, p_size AS CC, p_brand FROM part WHERE p_size <= 25
  UNION ALL BY NAME
  SELECT p_partkey, p_brand, p_type FROM part WHERE p_size > 25
) u
""",
    "programas_activos": """
SELECT p_partkey AS id, p_name AS nombre_excel, p_brand AS nombre_monitor,
       coalesce(nullif(p_type, 'STANDARD'), '') AS nombre_salida,
       coalesce(nullif(p_brand, 'Brand#4'), '') AS directorio
FROM part WHERE p_size <= 25
""",
    "agentes_activos": """
SELECT CAST(s_suppkey AS VARCHAR) AS log_name FROM supplier WHERE s_acctbal >= 0
""",
    "importe_formateado": """
SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS id_txt,
       translate(format('{:,.2f}', round(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(12.345 AS DECIMAL(5,3)), 2)), ',.', '.,') AS importe_txt
FROM part
""",
}

# The load path and the rest of the registered operators.
_CON = "WITH {calls}, {per_agent}, {det}".format(calls=_CALLS, per_agent=_PER_AGENT, det=_DET)
_BLOQUES = {
    "calls": _CALLS,
    "per_agent": _PER_AGENT,
    "det": _DET,
    "r2": ORACLE["dias_con_total"].strip().removeprefix(_CON),
    "r3": ORACLE["dias_por_grupo"].strip().removeprefix(_CON),
}
for _otro in (catalog_load, catalog_slices):
    QUERIES |= _otro.QUERIES
    ORACLE |= _otro.oraculos(_BLOQUES)
