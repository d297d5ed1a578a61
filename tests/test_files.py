"""Reading delimited exports with mixed headers, and the idempotent load."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.fixtures import dims
from workdays.model import Period
from workdays.plans import ingest
from workdays.sources import files

HDR = ["Call day", "Call time", "Caller", "Length", "Station", "Voice file", "Login name", "Call result"]


def _write(path, header, rows, encoding="utf-8", bom=False):
    text = "\n".join(";".join(r) for r in [header, *rows]) + "\n"
    data = text.encode(encoding)
    if bom:
        data = b"\xef\xbb\xbf" + data
    with open(path, "wb") as f:
        f.write(data)


@pytest.fixture()
def carpeta(tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    # BOM, normal header
    _write(d / "201708 REL to_access.csv", HDR, [
        ["19/8/2017 0:00:00", "30/12/1899 7:54:15", "600000000", "56,00", "S1", "v1", "ana", "Request"],
        ["19/8/2017", "7:54:15", "600000000", "56,00", "S1", "v1", "ana", "Other"],  # key conflict in file
        ["31/2/2017", "7:54:15", "600000001", "10", "S1", "v1", "bob", "Request"],  # bad date
    ], bom=True)
    # CC in the middle, corrupt first header
    _write(d / "201709 REL to_access.csv", ["ÿDay", "Call time", "Caller", "Length", "CC", "Station", "Voice file", "Login name", "Call result"], [
        ["2017-09-01", "7:5:3", "600000002", "12", "X", "S2", "v2", "bob", "Req"],
    ])
    # no trailing column, another programme output name with a space and '+'
    _write(d / "201709 A+B C to_access.csv", HDR[:-1], [
        ["2017/09/02", "07:00:00", "600000003", "5,5", "S3", "v3", "cid"],
    ])
    # no output part (programme with NULL nombre_salida)
    _write(d / "201709 to_access.csv", HDR, [
        ["2/9/2017", "08:00:00", "600000004", "", "S4", "v4", "dan", "Req"],  # empty length
        ["3/9/2017", "08:00:00", "600000005", "-5,9", "S4", "v4", "dan", "Req"],
    ])
    return str(d)


def test_reads_by_header_name(spark, carpeta):
    df = files.leer_delimitado(spark, f"{carpeta}/*to_access.csv")
    assert df.count() == 7
    rows = {(r["archivo"], r["llamante"]): r for r in df.collect()}
    r = rows[("201709 REL to_access.csv", "600000002")]
    assert (r["fecha_txt"], r["log_name"], r["station"], r["resultado"]) == ("2017-09-01", "bob", "S2", "Req")
    r = rows[("201709 A+B C to_access.csv", "600000003")]
    assert r["resultado"] is None and r["log_name"] == "cid" and r["salida"] == "A+B C"
    r = rows[("201708 REL to_access.csv", "600000000")]
    assert r["salida"] == "REL" and r["clave_archivo"] == "201708"
    assert rows[("201709 to_access.csv", "600000004")]["salida"] is None
    assert "CC" not in df.columns


def test_glob_by_output_name(spark, carpeta):
    df = files.leer_cargas(spark, carpeta, salida="REL")
    assert {r["archivo"] for r in df.collect()} == {"201708 REL to_access.csv", "201709 REL to_access.csv"}
    assert files.leer_cargas(spark, carpeta, salida="A+B C").count() == 1


def test_no_matching_file_gives_empty(spark, carpeta):
    df = files.leer_cargas(spark, carpeta, salida="NADA")
    assert df.count() == 0 and df.columns == files.COLUMNAS


def test_exports_of_a_month(spark, tmp_path):
    d = tmp_path / "xls"
    d.mkdir()
    _write(d / "20170801 REL multioption_monitor_08_53_14.csv", HDR, [["1/8/2017", "7:00:00", "1", "3", "s", "v", "ana", "r"]])
    _write(d / "20170802 REL multioption_monitor_09_00_00.csv", HDR[:4] + ["CC"] + HDR[4:], [["2/8/2017", "7:00:00", "2", "4", "c", "s", "v", "bob", "r"]])
    _write(d / "20170901 REL multioption_monitor_09_00_00.csv", HDR, [["1/9/2017", "7:00:00", "3", "4", "s", "v", "cid", "r"]])
    df = files.leer_exportaciones(spark, str(d), Period(2017, 8), "REL")
    got = sorted((r["clave_archivo"], r["log_name"], r["station"]) for r in df.collect())
    assert got == [("20170801", "ana", "s"), ("20170802", "bob", "s")]


def test_cp1252_file(spark, tmp_path):
    d = tmp_path / "enc"
    d.mkdir()
    _write(d / "201708 to_access.csv", HDR, [["1/8/2017", "7:00:00", "1", "3", "s", "v", "Íñigo", "r"]], encoding="cp1252")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        df = files.leer_cargas(spark, str(d), encoding="windows-1252")
        assert df.first()["log_name"] == "Íñigo"
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")
    df = files.leer_cargas(spark, str(d), encoding="ISO-8859-1")
    assert df.first()["log_name"] == "Íñigo"


def test_file_without_header_is_quarantined(spark, tmp_path):
    d = tmp_path / "nohdr"
    d.mkdir()
    _write(d / "201708 to_access.csv", ["1/8/2017", "7:00:00", "1", "3", "s", "v", "ana", "r"], [])
    df = files.leer_cargas(spark, str(d))
    assert [r["motivo_archivo"] for r in df.collect()] == ["cabecera"]


def test_ingest_is_idempotent(spark, carpeta, tmp_path):
    _, _, programas = dims(spark)
    programas = programas.union(
        spark.createDataFrame([(20, "AB", "AB", "A+B C", None, 1, "20:00:00", None)], programas.schema)
    )
    destino = str(tmp_path / "llamadas")
    crudo = files.leer_delimitado(spark, f"{carpeta}/*to_access.csv")
    buenas, malas = ingest.preparar(crudo, programas)
    r1 = ingest.cargar(spark, destino, buenas, cuarentena=malas, destino_cuarentena=str(tmp_path / "cuarentena"))
    assert r1.insertadas == 4  # 7 rows - 1 key conflict - 2 quarantined
    assert r1.cuarentena == 2
    r2 = ingest.cargar(spark, destino, buenas)
    assert r2.insertadas == 0
    tabla = spark.read.parquet(destino)
    assert tabla.count() == 4
    first = tabla.where(F.col("llamante") == "600000000").first()
    assert first["resultado"] == "Request"  # the first row of the file
    progs = {r["log_name"]: r["programa_id"] for r in tabla.collect()}
    assert progs == {"ana": 18, "bob": 18, "cid": 20, "dan": 17}
    assert tabla.where("log_name = 'dan'").first()["dur"] == -5
    assert {r["anio_mes"] for r in tabla.collect()} == {"2017-08", "2017-09"}
    motivos = sorted(r["motivo"] for r in spark.read.parquet(str(tmp_path / "cuarentena")).collect())
    assert motivos == ["dur", "fecha"]


def test_ingest_with_chosen_programme(spark, carpeta, tmp_path):
    crudo = files.leer_cargas(spark, carpeta, salida="REL")
    buenas, malas = ingest.preparar(crudo, programa_id=18)
    assert {r["programa_id"] for r in buenas.collect()} == {18}
    assert buenas.count() == 3 and malas.count() == 1


def test_unknown_output_name_is_quarantined(spark, carpeta):
    _, _, programas = dims(spark)
    crudo = files.leer_delimitado(spark, f"{carpeta}/*to_access.csv")
    _, malas = ingest.preparar(crudo, programas)
    assert {r["archivo"] for r in malas.where(F.col("motivo").contains("programa")).collect()} == {"201709 A+B C to_access.csv"}


def test_month_of_exports_straight_into_the_table(spark, tmp_path):
    """The reference concatenates a month of exports into one file, then loads it;
    here the exports are read and loaded in one job, aligned by header."""
    d = tmp_path / "exports"
    d.mkdir()
    _write(d / "20170801 REL multioption_monitor_08_53_14.csv", HDR, [["1/8/2017", "7:00:00", "1", "3,00", "s", "v", "ana", "r"]])
    _write(d / "20170802 REL multioption_monitor_09_00_00.csv", HDR[:4] + ["CC"] + HDR[4:], [
        ["2/8/2017", "7:00:00", "2", "4", "c", "s", "v", "bob", "r"],
        ["2/8/2017", "7:00:00", "2", "5", "c", "s", "v", "bob", "r"],
    ])
    _write(d / "20170803 multioption_monitor_09_00_00.csv", HDR, [["3/8/2017", "7:00:00", "3", "4", "s", "v", "cid", "r"]])
    _, _, programas = dims(spark)
    crudo = files.leer_exportaciones(spark, str(d), Period(2017, 8), "REL")
    buenas, malas = ingest.preparar(crudo, programas)
    destino = str(tmp_path / "llamadas")
    r = ingest.cargar(spark, destino, buenas)
    assert r.insertadas == 2 and malas.count() == 0
    t = spark.read.parquet(destino)
    assert sorted((x["log_name"], x["dur"], x["programa_id"]) for x in t.collect()) == [("ana", 3, 18), ("bob", 4, 18)]


def test_exports_consolidated_into_monthly_files_and_loaded(spark, tmp_path):
    d = tmp_path / "exports"
    d.mkdir()
    _write(d / "20170801 A+B multioption_monitor_08_53_14.csv", HDR, [["1/8/2017", "7:00:00", "1", "3,00", "s", "v", "ana", "r"]])
    _write(d / "20170802 A+B multioption_monitor_09_00_00.csv", HDR[:4] + ["CC"] + HDR[4:], [["2/8/2017", "7:00:00", "2", "4", "c", "s", "v", "bob", "r"]])
    crudo = files.leer_exportaciones(spark, str(d), Period(2017, 8), "A+B")
    out = str(tmp_path / "cargas")
    from workdays.sources.sinks import escribir_delimitado
    assert escribir_delimitado(files.carga_mensual(crudo), out, ("salida", "anio_mes")) == 2
    header = open(next((tmp_path / "cargas").glob("salida=*/anio_mes=201708/*.csv"))).readline().strip()
    assert header == ";".join(HDR)
    back = files.leer_delimitado(spark, f"{out}/*/*/*.csv")
    rows = sorted((r["log_name"], r["salida"], r["clave_archivo"], r["station"]) for r in back.collect())
    assert rows == [("ana", "A+B", "201708", "s"), ("bob", "A+B", "201708", "s")]


def test_ingest_in_one_pass(spark, carpeta, tmp_path):
    _, _, programas = dims(spark)
    programas = programas.union(
        spark.createDataFrame([(20, "AB", "AB", "A+B C", None, 1, "20:00:00", None)], programas.schema)
    )
    destino = str(tmp_path / "llamadas")
    crudo = files.leer_delimitado(spark, f"{carpeta}/*to_access.csv")
    r = ingest.ingerir(spark, destino, crudo, programas, destino_cuarentena=str(tmp_path / "cuar"))
    assert (r.insertadas, r.cuarentena) == (4, 2)
    assert ingest.ingerir(spark, destino, crudo, programas).insertadas == 0


def test_consolidated_without_output_name_reads_back_as_none(spark, tmp_path):
    d = tmp_path / "exports"
    d.mkdir()
    _write(d / "20170801 multioption_monitor_08_53_14.csv", HDR, [["1/8/2017", "7:00:00", "1", "3", "s", "v", "ana", "r"]])
    crudo = files.leer_exportaciones(spark, str(d), Period(2017, 8))
    from workdays.sources.sinks import escribir_delimitado
    out = str(tmp_path / "cargas")
    assert escribir_delimitado(files.carga_mensual(crudo), out, ("salida", "anio_mes")) == 1
    back = files.leer_delimitado(spark, f"{out}/*/*/*.csv").collect()
    assert [(r["log_name"], r["salida"], r["clave_archivo"]) for r in back] == [("ana", None, "201708")]


def test_repeated_header_line_is_not_data(spark, tmp_path):
    d = tmp_path / "dup"
    d.mkdir()
    _write(d / "201708 to_access.csv", HDR, [
        ["1/8/2017", "7:00:00", "1", "3", "s", "v", "ana", "r"],
        HDR,  # the header again, e.g. two exports pasted together
        ["2/8/2017", "7:00:00", "2", "4", "s", "v", "bob", "r"],
    ])
    rows = files.leer_cargas(spark, str(d)).collect()
    assert sorted(r["log_name"] for r in rows) == ["ana", "bob"]


def _cargar_dos_veces(spark, d, tmp_path, **kw):
    destino, cuar = str(tmp_path / "llamadas"), str(tmp_path / "cuar")
    r = [
        ingest.ingerir(spark, destino, files.leer_delimitado(spark, f"{d}/*to_access.csv"), destino_cuarentena=cuar, **kw)
        for _ in range(2)
    ]
    malas = spark.read.parquet(cuar) if r[0].cuarentena else None
    return r, spark.read.parquet(destino), malas


def test_loading_twice_with_empty_fields_equals_once(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    _write(d / "201708 to_access.csv", HDR, [
        ["1/8/2017", "7:00:00", "", "3", "s", "v", "ana", "r"],
        ["1/8/2017", "7:00:00", "1", "3", "s", "v", "", ""],
        ["1/8/2017", "7:00:00", "1", "3", "", "v", "bob", "r"],
        ["99/8/2017", "7:00:00", "1", "3", "", "v", "bob", "r"],
    ])
    r, tabla, malas = _cargar_dos_veces(spark, d, tmp_path, programa_id=17)
    assert [x.insertadas for x in r] == [3, 0] and tabla.count() == 3
    assert malas.count() == 1  # the file's quarantine replaces itself
    assert tabla.where("llamante = ''").count() == 1 and tabla.where("log_name = '' and resultado = ''").count() == 1
    from workdays.operators.filters import excluir_agentes
    assert excluir_agentes(tabla, ["x"]).count() == 3  # an empty name is a name


def test_equally_named_files_of_different_folders_keep_their_quarantine(spark, tmp_path):
    cuar, name = str(tmp_path / "cuar"), "201708 to_access.csv"
    for d, agent in (("a", "ana"), ("b", "bob")):
        (tmp_path / d).mkdir()
        _write(tmp_path / d / name, HDR, [["99/8/2017", "7:00:00", "1", "3", "s", "v", agent, "r"]])
    for d in ("a", "b", "a"):
        crudo = files.leer_delimitado(spark, f"{tmp_path}/{d}/*.csv")
        assert ingest.ingerir(spark, str(tmp_path / "t"), crudo, programa_id=17, destino_cuarentena=cuar).cuarentena == 1
    rows = spark.read.parquet(cuar).collect()
    assert sorted((r["archivo"], r["log_name"]) for r in rows) == [(name, "ana"), (name, "bob")]


def test_columns_beyond_any_fixed_width(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    extra = [f"X{i}" for i in range(40)]
    _write(d / "201708 to_access.csv", [HDR[0], *extra, *HDR[1:]], [["1/8/2017", *extra, "7:00:00", "1", "3", "s", "v", "ana", "r", "more", "fields"]])
    _write(d / "201709 to_access.csv", HDR, [["1/9/2017", "7:00:00", "1", "3", "s", "v", "bob", "q"]])
    rows = sorted((r["log_name"], r["resultado"], r["motivo_archivo"]) for r in files.leer_cargas(spark, str(d)).collect())
    assert rows == [("ana", "r", None), ("bob", "q", None)]


def test_cc_in_any_place(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    for k in range(3):
        at = (0, 1, 8)[k]
        fila = [f"{k + 1}/8/2017", "7:00:00", "1", "3", "s", "v", "ana", "r"]
        _write(d / f"20170{k + 1} to_access.csv", [*HDR[:at], "CC", *HDR[at:]], [[*fila[:at], "x", *fila[at:]]])
    rows = files.leer_cargas(spark, str(d)).collect()
    assert sorted(r["fecha_txt"] for r in rows) == ["1/8/2017", "2/8/2017", "3/8/2017"]
    assert {(r["hora_txt"], r["resultado"], r["motivo_archivo"]) for r in rows} == {("7:00:00", "r", None)}


def test_patterns_without_files_take_nothing_away(spark, carpeta):
    one = files.leer_delimitado(spark, f"{carpeta}/*REL*.csv")
    two = files.leer_delimitado(spark, [f"{carpeta}/nope*.csv", f"{carpeta}/*REL*.csv", "/tmp/run-nowhere/*.csv"])
    assert one.count() == two.count() == 4
    assert files.leer_delimitado(spark, ["/tmp/run-nowhere/*.csv"]).count() == 0


def test_quotes_separators_and_line_breaks(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    body = [
        '1/8/2017;7:00:00;1;3;"say ""hi"";x";v;ana;r',
        '2/8/2017;7:00:00;1;3;"C:\\rec;\\";v;bob;r',
        '3/8/2017;7:00:00;1;3;5" disc;v;cid;r',
        '4/8/2017;7:00:00;1;3;"two', 'lines";v;dan;r',
    ]
    (d / "201708 to_access.csv").write_text("\n".join([";".join(HDR), *body]) + "\n")
    rows = {r["fecha_txt"]: r for r in files.leer_cargas(spark, str(d)).collect()}
    assert [(rows[f"{k}/8/2017"]["station"], rows[f"{k}/8/2017"]["log_name"]) for k in (1, 2, 3)] == [
        ('say "hi";x', "ana"), ("C:\\rec;\\", "bob"), ('5" disc', "cid")]
    assert rows["4/8/2017"]["motivo_archivo"] == "comillas"
    buenas, malas = ingest.preparar(files.leer_cargas(spark, str(d)), programa_id=1)
    assert buenas.count() == 3 and malas.count() == 2
    whole = {r["fecha_txt"]: r for r in files.leer_delimitado(spark, f"{d}/*to_access.csv", multilinea=True).collect()}
    assert len(whole) == 4 and (whole["4/8/2017"]["station"], whole["4/8/2017"]["log_name"]) == ("two\nlines", "dan")


def test_ambiguous_output_names_are_quarantined_not_multiplied(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    _write(d / "201708 to_access.csv", HDR, [[f"{k}/8/2017", "7:00:00", "1", "3", "s", "v", "ana", "r"] for k in (1, 2, 3)])
    programas = lambda *p: spark.createDataFrame(list(p), "id int, nombre_salida string, activo int")
    one = programas((1, None, 1), (2, "", 0), (3, None, 0))
    r, tabla, _ = _cargar_dos_veces(spark, d, tmp_path / "a", programas=one)
    assert [x.insertadas for x in r] == [3, 0] and {x["programa_id"] for x in tabla.collect()} == {1}
    buenas, malas = ingest.preparar(files.leer_cargas(spark, str(d)), programas((1, None, 1), (2, "", 1)))
    assert buenas.count() == 0 and [r["motivo"] for r in malas.collect()] == ["programa_ambiguo"] * 3


def test_key_without_the_day_meets_every_month(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    _write(d / "201708 to_access.csv", HDR, [["1/8/2017", "7:00:00", "1", "3", "s", "v", "ana", "r"]])
    destino, key = str(tmp_path / "llamadas"), ("llamante", "log_name")
    leer = lambda: files.leer_cargas(spark, str(d))
    assert ingest.ingerir(spark, destino, leer(), programa_id=1, key_cols=key).insertadas == 1
    _write(d / "201708 to_access.csv", HDR, [["1/9/2017", "8:00:00", "1", "3", "s", "v", "ana", "r"]])
    assert ingest.ingerir(spark, destino, leer(), programa_id=1, key_cols=key).insertadas == 0


def test_load_leaves_no_intermediate_files(spark, carpeta, tmp_path):
    from workdays.session import ensure_checkpoint_dir

    base = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file://").removeprefix("file:"), "cargas")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    _, _, programas = dims(spark)
    ingest.ingerir(spark, str(tmp_path / "t"), files.leer_delimitado(spark, f"{carpeta}/*to_access.csv"), programas)
    assert (set(os.listdir(base)) if os.path.isdir(base) else set()) == before
