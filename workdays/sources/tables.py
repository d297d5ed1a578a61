"""Table scans (S7) and the generated tables used as stand-ins for the call-centre tables.

Stand-in mapping (columns only renamed or cast; no rows are dropped):

  calls       <- lineitem: fecha = l_shipdate as date, log_name = l_suppkey as text,
                 programa_id = l_partkey, llamante = l_orderkey, dur = l_quantity
  calls (R4)  <- events: fecha = ts as date, log_name = user_id,
                 programa_id = event_type, dur = floor(value)
  agentes     <- supplier: log_name = s_suppkey as text, nombre = s_name, grupo = s_nationkey
  grupos      <- nation: grupo = n_nationkey, grupo_desc = n_name
  programas   <- part: id = p_partkey, nombre_monitor = p_brand,
                 factura_hora = p_retailprice as decimal(10,2)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import RATE


# Declared schemas of the generated tables: no footer is read to infer them.
ESQUEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def tabla(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table; projections and filters applied later reach the scan."""
    reader = spark.read
    if name in ESQUEMAS:
        reader = reader.schema(ESQUEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def llamadas(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = tabla(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").cast("date").alias("fecha"),
        F.date_format("l_shipdate", "HH:mm:ss").alias("hora"),
        F.col("l_orderkey").cast("string").alias("llamante"),
        F.col("l_quantity").cast("int").alias("dur"),
        F.col("l_returnflag").alias("station"),
        F.col("l_linestatus").alias("voice_file"),
        F.col("l_suppkey").cast("string").alias("log_name"),
        F.col("l_linenumber").cast("string").alias("resultado"),
        F.col("l_partkey").alias("programa_id"),
    )


def llamadas_eventos(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = tabla(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").cast("date").alias("fecha"),
        F.date_format("ts", "HH:mm:ss").alias("hora"),
        F.col("event_id").cast("string").alias("llamante"),
        F.floor("value").cast("int").alias("dur"),
        F.col("user_id").alias("log_name"),
        F.col("event_type").alias("programa_id"),
    )


def agentes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tabla(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("string").alias("log_name"),
        F.col("s_name").alias("nombre"),
        F.col("s_nationkey").alias("grupo"),
        F.when(F.col("s_acctbal") >= 0, 1).otherwise(0).alias("activo"),
    )


def grupos(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = tabla(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("grupo"), F.col("n_name").alias("grupo_desc"))


def programas(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = tabla(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("nombre_excel"),
        F.col("p_brand").alias("nombre_monitor"),
        F.nullif(F.col("p_type"), F.lit("STANDARD")).alias("nombre_salida"),
        F.nullif(F.col("p_brand"), F.lit("Brand#4")).alias("directorio"),
        F.when(F.col("p_size") <= 25, 1).otherwise(0).alias("activo"),
        F.format_string("%02d:00:00", F.col("p_size") % 24).alias("hora_fin"),
        F.col("p_retailprice").cast(RATE).alias("factura_hora"),
    )
