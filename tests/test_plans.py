"""Plan checks: pushdown, no Python UDF, broadcast dimensions, pre-aggregation."""

import pytest

from tests.conftest import SF_SMALL
from workdays import catalog
from workdays.catalog import MES
from workdays.plans import reports
from workdays.sources import tables as t


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_filter_reaches_scan(spark):
    df = reports.dias_por_agente(t.llamadas(spark, SF_SMALL), period=MES)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,1998-11-01" in plan


def test_scan_reads_only_needed_columns(spark):
    df = reports.dias_por_agente(t.llamadas(spark, SF_SMALL))
    plan = _plan(df)
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_dimensions_broadcast_after_preaggregation(spark):
    d = SF_SMALL
    df = reports.dias_con_total(t.llamadas(spark, d), t.agentes(spark, d), t.grupos(spark, d), t.programas(spark, d))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 3
    # the distinct (programme, agent, day) reduction has a map-side partial aggregate
    assert "HashAggregate" in plan


def test_month_prunes_stored_partitions(spark, tmp_path):
    import datetime as dt

    from workdays.model import Period
    from workdays.plans import ingest

    rows = [(dt.date(2022, m, 1), "10:00:00", "1", 5, None, None, "ana", "r", 17, f"2022-{m:02d}") for m in range(1, 13)]
    spark.createDataFrame(rows, ingest.TABLA).write.partitionBy("anio_mes").parquet(str(tmp_path / "t"))
    calls = spark.read.parquet(str(tmp_path / "t"))
    df = reports.dias_por_agente(calls, period=Period(2022, 3))
    assert "PartitionFilters: [isnotnull(anio_mes" in _plan(df) and "(anio_mes" in _plan(df) and "= 2022-03)" in _plan(df)
    assert [r.n_dias for r in df.collect()] == [1]


def test_reader_broadcasts_the_header_table(spark, tmp_path):
    from tests.test_files import HDR, _write
    from workdays.sources import files

    d = tmp_path / "csv"
    d.mkdir()
    _write(d / "201708 to_access.csv", HDR, [["1/8/2017", "7:00:00", "1", "3", "s", "v", "ana", "r"]])
    df = files.leer_delimitado(spark, f"{d}/*to_access.csv")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.fixture()
def without_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def test_insert_ignore_shuffles_the_batch_once(spark, without_broadcast, tmp_path):
    from pyspark.sql import functions as F

    from workdays.operators.load import insertar_ignorando

    batch = spark.range(100).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), "id")
    target = spark.range(0, 100, 2).select(F.col("id").alias("k"), "id")
    df = insertar_ignorando(target, batch, ["k"])
    plan = _plan(df)
    # one exchange for each side of the anti-join; the grouping that follows needs none
    assert plan.count("Exchange hashpartitioning(_sal#") == 2 and plan.count("Exchange") == 2
    assert "SortMergeJoin [_sal#" in plan
    assert df.count() == 34 + 33


def test_coverage_reads_the_calls_once(spark):
    progs, recibidos = catalog._marcas(spark, SF_SMALL)
    from workdays.plans import coverage

    plan = _plan(coverage.cobertura(recibidos))
    assert plan.count("lineitem.parquet") == 1


def test_no_job_runs_while_a_plan_is_built(spark):
    sc = spark.sparkContext
    perezosas = sorted(set(catalog.QUERIES) - set(catalog.catalog_load.QUERIES) - set(catalog.catalog_slices.QUERIES))
    sc.setJobGroup("planes", "plans only")
    try:
        for name in perezosas:
            catalog.QUERIES[name](spark, SF_SMALL)
        assert list(sc.statusTracker().getJobIdsForGroup("planes")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_days_per_agent_take_one_exchange(spark):
    plan = _plan(reports.dias_por_agente(t.llamadas(spark, SF_SMALL)))
    assert plan.count("Exchange") == 1 and "partial_bit_or" in plan


def test_stored_buckets_are_not_shuffled(spark, without_broadcast, tmp_path):
    from pyspark.sql import functions as F

    from workdays.plans import cubos

    calls = t.llamadas(spark, SF_SMALL).withColumn("programa_id", F.col("programa_id").cast("int"))
    calls = calls.withColumn("anio_mes", F.date_format("fecha", "yyyy-MM"))
    for nombre, n in (("cubos_iguales", int(spark.conf.get("spark.sql.shuffle.partitions"))), ("cubos_otros", 5)):
        cubos.crear(spark, nombre, str(tmp_path / nombre), n)
        assert cubos.cargar(spark, nombre, calls.where("fecha < DATE'1996-01-01'")) > 0
        plan = _plan(cubos.nuevas(spark, nombre, calls))
        lines = plan.splitlines()
        scan = next(k for k, x in enumerate(lines) if f"default.{nombre}[" in x)
        join = max(k for k, x in enumerate(lines[:scan]) if "SortMergeJoin" in x)
        sides = [k for k, x in enumerate(lines) if join < k < scan and "Sort [fecha" in x]
        assert not [x for x in lines[max(sides) : scan] if "Exchange" in x]  # nothing moves on the stored side
        assert sum("Exchange" in x for x in lines) == (1 if n != 5 else 2)
        assert cubos.cargar(spark, nombre, calls) + cubos.cargar(spark, nombre, calls) > 0
        assert spark.table(nombre).count() == calls.dropDuplicates(["fecha", "hora", "llamante", "log_name", "programa_id"]).count()
        spark.sql(f"DROP TABLE {nombre}")


def test_a_key_is_collapsed_before_the_shuffle(spark, without_broadcast):
    from pyspark.sql import functions as F

    from workdays.operators.load import insertar_ignorando

    batch = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = _plan(insertar_ignorando(spark.range(3).select(F.col("id").alias("k"), "id"), batch, ["k"]))
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(_sal#")


def test_places_without_a_single_task(spark):
    from workdays.operators.orden import numerar

    df = numerar(spark.range(1000).selectExpr("nullif(id % 300, 5) AS a", "id"), ["a", "id"])
    assert "SinglePartition" not in _plan(df)
    rows = sorted(df.collect(), key=lambda r: r.posicion)
    assert [r.posicion for r in rows] == list(range(1, 1001))
    assert [(r.a, r.id) for r in rows] == sorted(((r.a, r.id) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert numerar(spark.range(0).selectExpr("id"), ["id"]).count() == 0


def test_labels_meet_names_by_suffix(spark):
    plan = _plan(catalog.QUERIES["cobertura_etiquetas"](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in plan and "EndsWith" not in plan
