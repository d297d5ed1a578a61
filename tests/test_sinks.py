import datetime as dt

from pyspark.sql import functions as F

from workdays.sources.sinks import anexar, escribir_delimitado


def test_delimited_month_files_replace_only_their_partitions(spark, tmp_path):
    ruta = str(tmp_path / "csv")
    df = spark.createDataFrame(
        [(17, "2022-10", "ana", 1), (17, "2022-11", "bob", 2), (18, "2022-11", "cid", 3)],
        "programa_id int, anio_mes string, log_name string, dur int",
    )
    assert escribir_delimitado(df, ruta) == 3
    # refill one programme-month: the others survive (K4)
    nuevo = spark.createDataFrame([(17, "2022-11", "dan", 9)], df.schema)
    assert escribir_delimitado(nuevo, ruta) == 1
    back = spark.read.option("header", "true").option("sep", ";").csv(ruta)
    got = sorted((r["programa_id"], r["anio_mes"], r["log_name"]) for r in back.collect())
    assert got == [(17, "2022-10", "ana"), (17, "2022-11", "dan"), (18, "2022-11", "cid")]
    first_line = open(next((tmp_path / "csv" / "programa_id=17" / "anio_mes=2022-10").glob("*.csv"))).readline()
    assert first_line.strip() == "log_name;dur"


def test_append_counts_rows(spark, tmp_path):
    ruta = str(tmp_path / "p")
    df = spark.range(5).withColumn("d", F.lit(dt.date(2022, 1, 1)))
    assert anexar(df, ruta) == 5
    assert anexar(df.limit(2), ruta) == 2
    assert spark.read.parquet(ruta).count() == 7


def test_delimited_values_round_trip(spark, tmp_path):
    from workdays.sources import files

    valores = ["ana ", " b", 'q"x', '"', "a;b", "\\", "", "\\\"", '";"', "ñ  "]
    cols = ["Call day", "Call time", "Caller", "Length", "Station", "Voice file", "Login name", "Call result"]
    filas = [("1/8/2017", "7:00:00", str(k), "3", v, v, v, v, "X", "201708") for k, v in enumerate(valores)]
    df = spark.createDataFrame(filas, [*cols, "salida", "anio_mes"])
    ruta = str(tmp_path / "k1")
    assert escribir_delimitado(df, ruta, ("salida", "anio_mes")) == len(valores)
    back = files.leer_delimitado(spark, f"{ruta}/*/*/*.csv").collect()
    got = {int(r["llamante"]): {r[c] for c in ("station", "voice_file", "log_name", "resultado")} for r in back}
    assert got == {k: {v} for k, v in enumerate(valores)}


def test_quarantine_of_a_file_replaces_itself(spark, tmp_path):
    from workdays.sources.sinks import reemplazar_por_archivo

    ruta = str(tmp_path / "q")
    schema = "archivo string, x int"
    assert reemplazar_por_archivo(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], schema), ruta) == 3
    assert reemplazar_por_archivo(spark.createDataFrame([("a", 9)], schema), ruta) == 1
    assert sorted((r["archivo"], r["x"]) for r in spark.read.parquet(ruta).collect()) == [("a", 9), ("b", 3)]
