"""Run the heavy plans on deliberately skewed data and report task balance per stage.

One agent holds a third of all calls, one (programme, agent, day) a ninth, and in
the insert-ignore batch one key holds a third of the rows and another third have
a NULL key. The job writes Spark's event log to a fresh scratch folder and prints,
for every stage with a shuffle read, the largest and the median records read by
one task. Balanced plans keep the ratio small; a plan that sends a hot key to one
task shows max ~ a third of the stage's records.

Usage: python tools/skew_check.py [rows]   (default 3,000,000)
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from workdays.operators.load import insertar_ignorando  # noqa: E402
from workdays.plans import attendance, reports  # noqa: E402
from workdays.session import DEFAULTS  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    scratch = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    logs = os.path.join(scratch, "eventlog")
    os.makedirs(logs)
    b = SparkSession.builder.master("local[8]").appName("skew-check")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = (
        b.config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logs)
        .config("spark.eventLog.compress", "false")
        .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    i = F.col("id")
    hot = (i % 3) == 0
    calls = spark.range(n).select(
        # a ninth of the rows on one single (day, programme, agent)
        F.when(i % 9 == 0, F.lit("2022-03-01").cast("date"))
        .otherwise(F.date_add(F.lit("2022-01-01").cast("date"), ((i * 7) % 365).cast("int")))
        .alias("fecha"),
        F.lit("10:00:00").alias("hora"),
        (i % 1000).cast("string").alias("llamante"),
        (i % 600).cast("int").alias("dur"),
        F.lit(None).cast("string").alias("station"),
        F.lit(None).cast("string").alias("voice_file"),
        F.when(hot, F.lit("hot")).otherwise((i % 5000).cast("string")).alias("log_name"),
        F.lit("r").alias("resultado"),
        F.when(hot, F.lit(17)).otherwise((i % 200).cast("int")).alias("programa_id"),
    )
    path = os.path.join(scratch, "llamadas")
    calls.write.parquet(path)
    calls = spark.read.parquet(path)
    agentes = spark.range(5000).select(
        F.col("id").cast("string").alias("log_name"), F.lit("n").alias("nombre"),
        (F.col("id") % 25).cast("int").alias("grupo"), F.lit(1).alias("activo"),
    ).unionByName(spark.createDataFrame([("hot", "Hot", 1, 1)], "log_name string, nombre string, grupo int, activo int"))
    grupos = spark.range(25).select(F.col("id").cast("int").alias("grupo"), F.lit("g").alias("grupo_desc"))
    programas = spark.range(200).select(
        F.col("id").cast("int").alias("id"), F.lit("m").alias("nombre_monitor"), F.lit("23:00:00").alias("hora_fin"),
        F.lit(10).cast("decimal(10,2)").alias("factura_hora"), F.lit(1).alias("activo"),
    )

    spark.sparkContext.setJobDescription("R2 days with totals")
    reports.dias_con_total(calls, agentes, grupos, programas).write.format("noop").mode("overwrite").save()

    spark.sparkContext.setJobDescription("insert-ignore")
    batch = spark.range(n).select(
        F.when(i % 3 == 0, F.lit(None)).when(i % 3 == 1, F.lit(7)).otherwise(i).alias("k"),
        (i % 11).alias("v"),
    )
    target = spark.range(0, n, 2).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("v"))
    insertar_ignorando(target, batch, ["k"]).write.format("noop").mode("overwrite").save()

    spark.sparkContext.setJobDescription("attendance")
    pres = calls.select("fecha", "programa_id", "log_name")
    attendance.asistencia(calls, agentes, programas, pres).write.format("noop").mode("overwrite").save()
    spark.stop()

    recs: dict[tuple, list[int]] = defaultdict(list)
    names: dict[tuple, str] = {}
    desc: dict[int, str] = {}
    stage_job: dict[int, str] = {}
    for f in sorted(glob.glob(os.path.join(logs, "**", "*"), recursive=True)):
        if os.path.isdir(f):
            continue
        with open(f) as fh:
            for line in fh:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    d = (e.get("Properties") or {}).get("spark.job.description", "")
                    for s in e.get("Stage IDs", []):
                        stage_job[s] = d
                elif ev == "SparkListenerTaskEnd":
                    m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    r = m.get("Total Records Read", 0)
                    sid = e["Stage ID"]
                    recs[sid].append(r)
                elif ev == "SparkListenerStageCompleted":
                    names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:40]
    print(f"rows={n}  scratch={scratch}")
    print(f"{'job':22s} {'stage':>5s} {'tasks':>5s} {'records':>10s} {'max/task':>9s} {'median':>8s} {'max share':>9s}")
    for sid in sorted(recs):
        r = recs[sid]
        tot = sum(r)
        if tot == 0 or len(r) < 2:
            continue
        print(f"{stage_job.get(sid, '')[:22]:22s} {sid:5d} {len(r):5d} {tot:10d} {max(r):9d} {int(statistics.median(r)):8d} {max(r) / tot:9.1%}")


if __name__ == "__main__":
    main()
