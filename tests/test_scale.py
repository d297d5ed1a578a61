"""What must not grow faster than the input: code of a row, files of a slice, tasks of a scan, rows of a task."""

import contextlib
import io
import os
import random
import re

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from workdays import catalog_load, catalog_slices
from workdays.plans import ingest, reports
from workdays.sources import files, sinks
from workdays.sources import tables as t

# Longer methods are interpreted by the JVM for ever (HotSpot's HugeMethodLimit).
LIMITE_JIT = 8000


def _mayor_metodo(df) -> int:
    texto = io.StringIO()
    with contextlib.redirect_stdout(texto):
        df.explain("codegen")
    return max(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", texto.getvalue()))


def test_row_code_of_a_read_is_short_enough_to_be_compiled(spark):
    antes = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        crudo = files.leer_delimitado(spark, catalog_load._escribir(spark, SF_SMALL))
        assert _mayor_metodo(crudo) < LIMITE_JIT
        assert _mayor_metodo(ingest.normalizado(crudo, catalog_load._programas(spark))) < LIMITE_JIT
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", antes)


def test_rows_are_not_shuffled_to_their_headers(spark):
    crudo = files.leer_delimitado(spark, catalog_load._escribir(spark, SF_SMALL))
    plan = crudo._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_an_append_makes_few_files_a_slice(spark, tmp_path):
    df = spark.range(0, 4000, 1, 40).select("id", (F.col("id") % 5).cast("string").alias("mes"))
    assert sinks.anexar(df, str(tmp_path / "t"), ["mes"]) == 4000
    partes = [f for _, _, fs in os.walk(tmp_path / "t") for f in fs if f.endswith(".parquet")]
    assert len(partes) <= 10
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("mes").count().where("count = 800").count() == 5


def test_a_file_without_a_header_keeps_its_provenance(spark, tmp_path):
    (tmp_path / "201711 LLAM to_access.csv").write_text("1/11/2017;8:00:00;600\n")
    (tmp_path / "201712 LLAM to_access.csv").write_text("Call day;Call time;Caller\n1/12/2017;9:00:00;601\n")
    filas = files.leer_delimitado(spark, f"{tmp_path}/*.csv").collect()
    assert sorted((r.salida, r.clave_archivo, r.motivo_archivo, r.llamante) for r in filas) == [
        ("LLAM", "201711", "cabecera", None), ("LLAM", "201712", None, "601")]


def test_many_small_blocks_share_a_task(spark, tmp_path):
    lineas = ["Call day;Call time;Station", *[f'1/1/2017;8:00:{i % 60:02d};"a\n{i}"' for i in range(4000)]]
    (tmp_path / "x.csv").write_text("\n".join(lineas) + "\n")
    claves = {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "1"}
    antes = {k: spark.conf.get(k) for k in claves}
    try:
        for k, v in claves.items():
            spark.conf.set(k, v)
        texto = files._lineas_de_texto(spark, f"{tmp_path}/x.csv", "UTF-8")
        assert texto.select("_bloque").distinct().count() > 50
        assert texto.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        leidas = files.leer_delimitado(spark, f"{tmp_path}/x.csv", multilinea=True).select("station").collect()
    finally:
        for k, v in antes.items():
            spark.conf.set(k, v)
    assert sorted(r.station for r in leidas) == sorted(f"a\n{i}" for i in range(4000))


def test_agents_rows_are_not_sorted_for_their_programme(spark):
    dims = (t.agentes(spark, SF_SMALL), t.grupos(spark, SF_SMALL), t.programas(spark, SF_SMALL))
    plan = reports.dias_por_grupo(t.llamadas(spark, SF_SMALL), *dims)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ShuffledHashJoin [programa_id") == 2


def _por_tareas(spark, tareas, tramo):
    """60 rows in load-file form on each of ``tareas`` tasks, ``tramo`` (of their number) being their month."""
    mes = F.concat(F.lit("20"), F.lpad(tramo.cast("string"), 4, "0"))
    return spark.range(0, 60 * tareas, 1, tareas).select(F.col("id").cast("string").alias("Caller"), F.lit("S1").alias("salida"), mes.alias("anio_mes"))


def _repartos(monkeypatch):
    """For each frame that is written: how often its plan deals the rows anew, by request or for a join."""
    vistos = []
    real = sinks._escritor_csv

    def escritor(df, *a):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        vistos.append(plan.count("Exchange") + plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin"))
        return real(df, *a)

    monkeypatch.setattr(sinks, "_escritor_csv", escritor)
    return vistos


def _publicadas(ruta):
    return {f: (ruta / f).read_text().splitlines()[1:] for f in os.listdir(ruta) if not f.startswith((".", "_"))}


def test_slices_that_a_task_reads_whole_are_published_without_a_shuffle(spark, tmp_path, monkeypatch):
    vistos = _repartos(monkeypatch)
    n = 2 * spark.sparkContext.defaultParallelism
    assert sinks.publicar(_por_tareas(spark, n, F.floor(F.col("id") / 60)), f"{tmp_path}/p") == 60 * n
    assert vistos == [0]
    assert [len(x) for x in _publicadas(tmp_path / "p").values()] == [60] * n


def test_scattered_slices_are_shuffled_once(spark, tmp_path, monkeypatch):
    vistos = _repartos(monkeypatch)
    antes = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables larger than any threshold
        assert sinks.publicar(_por_tareas(spark, 16, F.col("id") % 4), f"{tmp_path}/p") == 960
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", antes)
    assert vistos == [1]
    assert sorted(len(x) for x in _publicadas(tmp_path / "p").values()) == [240] * 4


def test_whole_and_scattered_slices_are_published_together(spark, tmp_path, monkeypatch):
    vistos = _repartos(monkeypatch)
    n = 2 * spark.sparkContext.defaultParallelism
    df = _por_tareas(spark, n, F.when(F.col("id") % 3 == 0, 9999).otherwise(F.floor(F.col("id") / 60)))
    assert sinks.publicar(df, f"{tmp_path}/p") == 60 * n
    assert vistos == [0, 1]
    got = _publicadas(tmp_path / "p")
    assert {f: len(x) for f, x in got.items()} == {"209999 S1 to_access.csv": 20 * n} | {f"20{k:04d} S1 to_access.csv": 40 for k in range(n)}


def test_a_slice_that_moves_after_its_count_is_still_one_file(spark, tmp_path, monkeypatch):
    real = sinks._en_su_tarea
    monkeypatch.setattr(sinks, "_en_su_tarea", lambda *a: (sum(real(*a), []), []))
    assert sinks.publicar(_por_tareas(spark, 16, F.when(F.col("id") < 60, 9).otherwise(F.col("id") % 4)), f"{tmp_path}/p") == 960
    got = _publicadas(tmp_path / "p")
    assert {f: len(x) for f, x in got.items()} == {"200009 S1 to_access.csv": 60} | {f"20000{k} S1 to_access.csv": 225 for k in range(4)}
    assert sorted(int(x) for v in got.values() for x in v) == list(range(960))


def test_lines_made_after_the_shuffle_are_the_same_files(spark, tmp_path):
    lineas = catalog_slices._carga(catalog_load._lineas(spark, SF_SMALL))
    sinks.publicar(lineas, f"{tmp_path}/a", orden=["_orden"])
    cols = catalog_slices._publicar_origen(spark, SF_SMALL, f"{tmp_path}/b")
    assert cols == [c for c in lineas.columns if c not in ("salida", "anio_mes", "_orden")]
    a, b = _publicadas(tmp_path / "a"), _publicadas(tmp_path / "b")
    assert a == b and sum(map(len, a.values())) == t.tabla(spark, SF_SMALL, "lineitem").count()


def test_plain_lines_are_cut_without_the_parser(spark, tmp_path):
    """The parser takes several times as long; what it makes of a line is what the cut makes of it."""
    azar = random.Random(5)
    lineas = ["".join(azar.choice(["a", ";", " ", "é", "\t", "\\", "'", ","]) for _ in range(azar.randint(1, 14))) for _ in range(400)]
    lineas += ['"a;b";c', 'a"b;c', '"";x', '"a', "a;\x00b", ";;;;;;;;"]
    df = spark.createDataFrame(list(enumerate(lineas)), "_fila long, _linea string").withColumns({"_ruta": F.lit("r"), "_bloque": F.lit(0)})
    partidas = files.partir(df, 4)
    plan = partidas._jdf.queryExecution().optimizedPlan().toString()
    assert "split(_linea" in plan and "from_csv(StructField(_c0,StringType,true), StructField(_c1,StringType,true), StructField(_c2,StringType,true), StructField(_c3,StringType,true), (mode" in plan
    opciones = {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    quiere = {r._fila: list(r.c) for r in df.select("_fila", F.from_csv("_linea", files.esquema_posicional(4), opciones).alias("c")).collect()}
    for r in partidas.collect():
        campos = [x or None for x in r["_cs"]]
        assert campos + [None] * (4 - len(campos)) == quiere[r["_fila"]], lineas[r["_fila"]]


def test_lines_are_read_without_a_parser_for_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffx;1\r\n\n \t \n  y;é\n".encode() + b"z;\xff\n\x0b\n")
    leidas = files.leer_lineas(spark, f"{tmp_path}/a.csv")
    assert "FileScan text" in leidas._jdf.queryExecution().sparkPlan().toString()
    csv = spark.read.schema("_linea string").options(**files.OPCIONES_LINEA).option("encoding", "UTF-8").csv(f"{tmp_path}/a.csv")
    assert [r._linea for r in leidas.collect()] == [r._linea for r in csv.collect()] == ["x;1", "  y;é", "z;\ufffd"]


def test_the_copy_of_a_load_keeps_texts_only_of_quarantined_rows(spark, tmp_path):
    (tmp_path / "201711 A to_access.csv").write_text("Call day;Call time;Caller;Length\n1/11/2017;8:00:00;600;3\n99/11/2017;8:00:00;600;3\n")
    df = ingest.normalizado(files.leer_delimitado(spark, f"{tmp_path}/*.csv"), programa_id=1)
    filas = ingest._sin_textos(df).select("fecha_txt", "hora_txt", "dur_txt", "motivo").collect()
    assert sorted(map(tuple, filas), key=str) == [("99/11/2017", "8:00:00", "3", "fecha"), (None, None, None, None)]
    ingest.ingerir(spark, f"{tmp_path}/t", files.leer_delimitado(spark, f"{tmp_path}/*.csv"), programa_id=1, destino_cuarentena=f"{tmp_path}/q")
    assert [(r.fecha_txt, r.dur_txt) for r in spark.read.parquet(f"{tmp_path}/q").collect()] == [("99/11/2017", "3")]


def test_chosen_lines_with_a_fixed_text_are_the_same_files(spark, tmp_path):
    lineas = catalog_slices._carga(catalog_load._lineas(spark, SF_SMALL)).where("salida <> 'S2'").withColumn("Call result", F.lit("a"))
    sinks.publicar(lineas, f"{tmp_path}/a", orden=["_orden"])
    catalog_slices._publicar_origen(spark, SF_SMALL, f"{tmp_path}/b", "salida <> 'S2'", **{"Call result": "a"})
    a, b = _publicadas(tmp_path / "a"), _publicadas(tmp_path / "b")
    assert a == b and a and not any(" S2 " in f for f in a)


def test_published_rows_are_sorted_once_and_empty_names_are_one_file(spark, tmp_path, monkeypatch):
    vistos = []
    real = sinks._escritor_csv
    monkeypatch.setattr(sinks, "_escritor_csv", lambda df, *a: vistos.append(df.schema["salida"].nullable) or real(df, *a))
    df = spark.range(0, 40, 1, 4).select(
        F.col("id").cast("string").alias("Caller"), F.when(F.col("id") % 2 == 0, "").alias("salida"), F.lit("202201").alias("anio_mes"), "id")
    assert sinks.publicar(df, f"{tmp_path}/p", orden=["id"]) == 40
    assert vistos == [False]  # the writer sorts rows again to make NULL of '' in columns that may hold NULL
    got = _publicadas(tmp_path / "p")
    assert list(got) == ["202201 to_access.csv"]
    assert [int(x) for x in got["202201 to_access.csv"]] == list(range(40))


def test_lines_are_not_shuffled_to_be_joined_into_records(spark, tmp_path, monkeypatch):
    lineas = ["Call day;Call time;Station", *[f'1/1/2017;8:00:{i % 60:02d};"a\n{i};\n"' for i in range(500)], '1/1/2017;9:00:00;"open', "1/1/2017;9:00:01;x"]
    (tmp_path / "x.csv").write_text("\n".join(lineas) + "\n")
    planes, real = [], files.unir_registros

    def unir(df, *a):
        out = real(df, *a)
        planes.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(files, "unir_registros", unir)
    antes = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        leidas = files.leer_delimitado(spark, f"{tmp_path}/x.csv", multilinea=True).select("station", "motivo_archivo").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", antes)
    assert "hashpartitioning(_tarea" not in planes[0] and not re.search(r"hashpartitioning\(_ruta#\d+, _bloque#", planes[0])
    assert sorted((r.station for r in leidas if r.motivo_archivo is None), key=str) == sorted(f"a\n{i};\n" for i in range(500))
    assert [r.motivo_archivo for r in leidas if r.motivo_archivo] == ["comillas"]
    assert not [x.name for x in spark.catalog.listTables() if x.name.startswith("registros_")]


def test_export_rows_travel_before_their_texts_are_made(spark, monkeypatch):
    planes, real = [], sinks.escribir_delimitado

    def escribir(df, *a, **kw):
        planes.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *a, **kw)

    monkeypatch.setattr(sinks, "escribir_delimitado", escribir)
    patrones = catalog_load._escribir(spark, SF_SMALL)
    assert len(planes) == 2 and all(0 < p.index("format_string") < p.index("RepartitionByExpression") for p in planes)
    assert all(p.rindex("format_string") < p.index("RepartitionByExpression") for p in planes)
    leidas = files.leer_delimitado(spark, patrones)
    quiere = catalog_load._lineas(spark, SF_SMALL).selectExpr(
        "`Call day`", "`Call time`", "Caller", "Length", "Station", "`Voice file`", "`Login name`", "`Call result`", "salida", "anio_mes")
    got = leidas.select("fecha_txt", *files.CAMPOS, "salida", "clave_archivo")
    assert got.exceptAll(quiere).count() == quiere.exceptAll(got).count() == 0
