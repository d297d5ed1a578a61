"""Maintained tables: declared slices, named files, replay, roll-up states, long records, label suffixes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import calls, dims, llamada, reglas
from workdays.functions.normalize import periodo_valido, rango_valido
from workdays.model import PLACEHOLDER_CALLER, Period, prompt_period
from workdays.plans import coverage, estados, ingest, reports
from workdays.sources import files, sinks

HDR = ["Call day", "Call time", "Caller", "Length", "Station", "Voice file", "Login name", "Call result"]
D = dt.date


def _archivo(ruta, filas, cab=HDR):
    ruta.parent.mkdir(parents=True, exist_ok=True)
    ruta.write_text("\n".join(";".join(f) for f in [cab, *filas]) + "\n")


def _fila(dia, caller="1", dur="3", log="ana"):
    return [dia, "7:00:00", caller, dur, "s", "v", log, "r"]


def _cargar(spark, tmp_path, patron="?????? *to_access.csv", **kw):
    ruta = f"{tmp_path}/in/{patron}"
    crudo = files.leer_delimitado(spark, ruta)
    return ingest.ingerir(spark, f"{tmp_path}/llamadas", crudo, programa_id=17, destino_cuarentena=f"{tmp_path}/q",
                          leidos=files.archivos(spark, ruta), **kw)


def _filas(spark, ruta, *cols):
    return sorted((tuple(r) for r in spark.read.parquet(ruta).select(*cols).collect()), key=str)


# -- declared slices ----------------------------------------------------------------------------


def test_a_corrected_file_empties_its_quarantine(spark, tmp_path):
    _archivo(tmp_path / "in/201708 A to_access.csv", [_fila("1/8/2017"), _fila("99/8/2017", "2")])
    _archivo(tmp_path / "in/201709 A to_access.csv", [_fila("1/9/2017", "3", "?")])
    r = _cargar(spark, tmp_path)
    assert (r.insertadas, r.cuarentena) == (1, 2)
    _archivo(tmp_path / "in/201708 A to_access.csv", [_fila("1/8/2017"), _fila("9/8/2017", "2")])
    _archivo(tmp_path / "in/201709 A to_access.csv", [])  # a header and no row: declared by the listing alone
    r = _cargar(spark, tmp_path)
    assert (r.insertadas, r.cuarentena) == (1, 0)
    assert _filas(spark, f"{tmp_path}/llamadas", "llamante") == [("1",), ("2",)]
    assert not sinks.tramos_guardados(spark, f"{tmp_path}/q", ("origen",))


def test_only_declared_slices_are_emptied(spark, tmp_path):
    df = spark.createDataFrame([("A", "202211", "x"), ("", "202211", "y"), ("B c", "202212", "z")], "salida string, anio_mes string, v string")
    ruta = f"{tmp_path}/k"
    parts = ("salida", "anio_mes")
    assert sinks.escribir_delimitado(df, ruta, parts) == 3
    tramos = spark.createDataFrame([("", "202211"), ("B c", "202212"), ("no", "202301")], "salida string, anio_mes string")
    assert sinks.escribir_delimitado(df.where("v = 'z'"), ruta, parts, tramos=tramos) == 1
    assert set(sinks.tramos_guardados(spark, ruta, parts)) == {("A", "202211"), ("B c", "202212")}
    assert sinks.escribir_delimitado(df.limit(0), ruta, parts, tramos=tramos) == 0
    assert set(sinks.tramos_guardados(spark, ruta, parts)) == {("A", "202211")}
    assert sinks.escribir_delimitado(df.limit(0), ruta, parts) == 0  # nothing declared: nothing goes
    assert set(sinks.tramos_guardados(spark, ruta, parts)) == {("A", "202211")}


# -- named files --------------------------------------------------------------------------------


def _mensual(spark, filas):
    cols = ", ".join(f"`{h}` string" for h in HDR) + ", salida string, anio_mes string"
    return spark.createDataFrame([(*_fila(d, c), s, m) for d, c, s, m in filas], cols)


def test_months_are_published_under_their_names(spark, tmp_path):
    base = str(tmp_path / "out")
    filas = [("1/8/2017", "1", "REL+x y", "201708"), ("1/9/2017", "2", None, "201709")] + [("2/9/2017", str(k), "B", "201709") for k in range(40)]
    assert sinks.publicar(_mensual(spark, filas), base, filas_por_archivo=10) == 42
    names = sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith("."))
    assert names == ["201708 REL+x y to_access.csv", "201709 B to_access.csv", "201709 to_access.csv"]
    assert (tmp_path / "out/201709 B to_access.csv").is_dir()  # larger than one file may be
    for salida, n in (("REL+x y", 1), ("", 1), ("B", 40)):
        got = files.leer_cargas(spark, base, salida).collect()
        assert len(got) == n and {(r.salida or "", r.archivo[:6], r.clave_archivo) for r in got} == {(salida, filas[n == 40 or not salida][3], filas[n == 40 or not salida][3])}
    # a refill replaces the folder by a file; a declared month without rows goes, others stay
    tramos = spark.createDataFrame([("B", "201709"), ("REL+x y", "201708"), (None, "201710")], "salida string, anio_mes string")
    assert sinks.publicar(_mensual(spark, [("3/9/2017", "7", "B", "201709")]), base, tramos=tramos) == 1
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == ["201709 B to_access.csv", "201709 to_access.csv"]
    assert [r.llamante for r in files.leer_cargas(spark, base, "B").collect()] == ["7"]


def test_a_failing_publication_changes_nothing(spark, tmp_path):
    base = str(tmp_path / "out")
    sinks.publicar(_mensual(spark, [("1/8/2017", "1", "A", "201708")]), base)
    rota = _mensual(spark, [("1/8/2017", "2", "A", "201708")]).withColumn("Caller", F.raise_error(F.lit("on purpose")).cast("string"))
    with pytest.raises(Exception, match="on purpose"):
        sinks.publicar(rota, base)
    assert [r.llamante for r in files.leer_cargas(spark, base, "A").collect()] == ["1"]
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_publicar")]


def test_matched_files_are_listed_without_being_read(spark, tmp_path):
    _archivo(tmp_path / "in/201708 A b to_access.csv", [])
    (tmp_path / "in/201709 to_access.csv").write_text("")
    got = {(r.archivo, r.salida, r.clave_archivo, r.anio_mes) for r in files.archivos(spark, [f"{tmp_path}/in/*to_access.csv", f"{tmp_path}/none/*"]).collect()}
    assert got == {("201708 A b to_access.csv", "A b", "201708", "201708"), ("201709 to_access.csv", None, "201709", "201709")}
    assert files.archivos(spark, f"{tmp_path}/none/*").count() == 0


def test_equal_names_in_two_folders_have_one_order(spark, tmp_path):
    for carpeta in ("x", "y"):
        _archivo(tmp_path / f"{carpeta}/201708 to_access.csv", [[*_fila("1/8/2017")[:-1], f"from_{carpeta}"]])
    for k, orden in enumerate((["x", "y"], ["y", "x"])):
        crudo = files.leer_delimitado(spark, [f"{tmp_path}/{c}/*to_access.csv" for c in orden])
        ingest.ingerir(spark, f"{tmp_path}/t{k}", crudo, programa_id=17)
        assert _filas(spark, f"{tmp_path}/t{k}", "resultado") == [("from_x",)]


def test_only_the_header_line_sets_the_width(spark, tmp_path):
    _archivo(tmp_path / "in/201708 to_access.csv", [_fila("1/8/2017"), ["Call time" + ";" * 500]])
    lineas = files.leer_lineas(spark, f"{tmp_path}/in/*")
    assert files.ancho_de_cabeceras(lineas) == len(HDR)


# -- long records -------------------------------------------------------------------------------


def test_records_over_lines_in_small_blocks(spark, tmp_path):
    r = random.Random(4)
    esperado = []
    for f in range(3):
        filas = []
        for k in range(400):
            texto = "".join(r.choice(['a', 'b;', '"', "\n", "\n\n", ";", " ", 'x"y']) for _ in range(r.choice((0, 1, 2, 6 if f else 1))))
            if f == 2:
                texto = texto.replace("\n", "")  # a file without long records
            citado = '"' + texto.replace('"', '""') + '"' if set(texto) & set('";\n') else texto
            filas.append([f"{k % 28 + 1}/8/2017", "7:00:00", f"{f}-{k}", "3", citado, "v", "ana", "r"])
            esperado.append((f"{f}-{k}", texto))
        _archivo(tmp_path / f"in/20170{f + 1} to_access.csv", filas)
    claves = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    antes = {k: spark.conf.get(k) for k in claves}
    try:
        for k, v in claves.items():
            spark.conf.set(k, v)
        df = files.leer_delimitado(spark, f"{tmp_path}/in/*to_access.csv", multilinea=True)
        assert files.leer_lineas(spark, f"{tmp_path}/in/*").select("_bloque").distinct().count() > 20
        got = [(x.llamante, x.station, x.motivo_archivo) for x in df.collect()]
    finally:
        for k, v in antes.items():
            spark.conf.set(k, v)
    assert sorted(got) == sorted((c, s, None) for c, s in esperado)


def test_a_quote_that_is_never_closed_is_quarantined(spark, tmp_path):
    _archivo(tmp_path / "in/201708 to_access.csv", [_fila("1/8/2017"), ["2/8/2017", "7:00:00", '"never closed'], *[_fila("3/8/2017", str(k)) for k in range(30)]])
    lineas = files._lineas_de_texto(spark, f"{tmp_path}/in/*", "UTF-8")
    registros = files.unir_registros(lineas, max_lineas=10)
    got = files.alinear(files.partir(registros, len(HDR))).collect()
    assert sorted((x.fecha_txt, x.motivo_archivo) for x in got if not x.motivo_archivo) == [("1/8/2017", None)]
    assert sum(x.motivo_archivo == "comillas" for x in got) == 31


# -- replay of the quarantine -------------------------------------------------------------------


def _programas(spark, *ids):
    return spark.createDataFrame([(i, "A", 1) for i in ids], "id int, nombre_salida string, activo int")


@pytest.mark.parametrize("rota", [False, True])
def test_quarantined_rows_are_replayed_once(spark, tmp_path, monkeypatch, rota):
    sin_login = [h for h in HDR if h != "Login name"]  # log_name is NULL: such keys never conflict
    filas = [["1/8/2017", "7:00:00", "1", "3", "s", "v", "r"]] * 2 + [["99/8/2017", "7:00:00", "2", "3", "s", "v", "r"]]
    _archivo(tmp_path / "in/201708 A to_access.csv", filas, sin_login)
    destino, q = f"{tmp_path}/llamadas", f"{tmp_path}/q"
    r = ingest.ingerir(spark, destino, files.leer_cargas(spark, f"{tmp_path}/in", "A"), _programas(spark, 1, 2), destino_cuarentena=q)
    assert (r.insertadas, r.cuarentena) == (0, 3)
    assert ingest.reprocesar(spark, destino, q, _programas(spark, 1, 2)).insertadas == 0  # still two programmes
    if rota:
        with monkeypatch.context() as m:  # breaks off between the decision and its last step
            m.setattr(ingest, "tramos_guardados", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                ingest.reprocesar(spark, destino, q, _programas(spark, 1))
    ingest.reprocesar(spark, destino, q, _programas(spark, 1))
    r = ingest.reprocesar(spark, destino, q, _programas(spark, 1))
    assert (r.insertadas, r.cuarentena) == (0, 1)
    assert _filas(spark, destino, "llamante", "programa_id") == [("1", 1), ("1", 1)]
    assert _filas(spark, q, "fecha_txt", "motivo") == [("99/8/2017", "fecha")]
    assert ingest.reprocesar(spark, destino, f"{tmp_path}/none", _programas(spark, 1)).insertadas == 0


# -- roll-up states -----------------------------------------------------------------------------


def _lote(df):
    return df.withColumn("anio_mes", F.date_format("fecha", "yyyy-MM"))


def _iguales(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_reports_from_states_equal_reports_from_calls(spark, tmp_path):
    r = random.Random(2)
    rows = [llamada(D(2022, r.randint(10, 12), r.randint(1, 28)), r.choice(["ana", "bob", "Ana ", "cid", None]), r.choice([17, 18]),
                    dur=r.choice([0, 5, 9, None]), llamante=r.choice(["1", PLACEHOLDER_CALLER, None]), hora=f"10:00:{r.randint(10, 59)}") for _ in range(400)]
    rows.append(llamada(None, "ana", 17))
    todo = _lote(calls(spark, rows))
    destino, est = f"{tmp_path}/c", f"{tmp_path}/e"
    for desde, hasta in ((10, 11), (10, 12), (11, 12)):
        lote = todo.where((F.month("fecha") >= desde) & (F.month("fecha") <= hasta) | (F.col("fecha").isNull() & F.lit(desde == 11)))
        estados.cargar(spark, destino, est, lote)
    stored = spark.read.schema(ingest.TABLA).parquet(destino)
    e = estados.leer(spark, destino, est)
    dim, rg = dims(spark), reglas(spark, [(17, "2022-11", "ana"), (None, "2022-12", "bob")])
    for kw in ({}, {"period": Period(2022, 11)}, {"programa": 17}, {"reglas": rg}, {"excluir_marcadores": True}, {"colacion": "UTF8_LCASE_RTRIM"}):
        assert _iguales(reports.dias_por_agente(stored, **kw).drop("log_name"), estados.dias_por_agente(e, **kw).drop("log_name")), kw
        ours, plain = estados.informes_dias(e, *dim, **kw), reports.informes_dias(stored, *dim, **kw)
        # the name shown for names that a collation holds equal is one of them
        mostrado = ["log_name"] if "colacion" in kw else []
        assert all(_iguales(a.drop(*mostrado), b.drop(*mostrado)) for a, b in zip(plain[1:], ours[1:], strict=True)), kw
    for kw in ({}, {"mensual": True}, {"por_programa": False}, {"excluir_marcadores": True}, {"period": Period(2022, 10)}):
        assert _iguales(reports.media_por_agente(stored, **kw), estados.media_por_agente(e, **kw)), kw
    antes, filas = estados.dias_por_agente(e).count(), e.count()
    assert estados.compactar(spark, est) <= filas and estados.dias_por_agente(estados.leer(spark, destino, est)).count() == antes


def test_a_load_that_breaks_off_leaves_no_wrong_states(spark, tmp_path, monkeypatch):
    destino, est = f"{tmp_path}/c", f"{tmp_path}/e"
    uno = _lote(calls(spark, [llamada(D(2022, 11, 1), "ana", 17), llamada(D(2022, 12, 1), "ana", 17)]))
    dos = _lote(calls(spark, [llamada(D(2022, 11, 2), "ana", 17), llamada(D(2022, 11, 1), "ana", 17)]))
    estados.cargar(spark, destino, est, uno)
    real, veces = estados.anexar, []

    def falla(df, ruta, **kw):
        veces.append(ruta)
        if len(veces) == 2:
            raise RuntimeError("lost")
        return real(df, ruta, **kw)

    with monkeypatch.context() as m:
        m.setattr(estados, "anexar", falla)
        with pytest.raises(RuntimeError):
            estados.cargar(spark, destino, est, dos)
    got = {(r.mes, r.n_dias) for r in estados.dias_por_agente(estados.leer(spark, destino, est)).collect()}
    assert got == {(11, 2), (12, 1)}
    assert estados.cargar(spark, destino, est, dos) == 0


# -- labels, validation -------------------------------------------------------------------------


def test_labels_of_names_of_many_lengths(spark):
    nombres = ["A", "BA", "CBA", "x y", "", "ñandú", None, "A - 2022-11-03"]
    progs = spark.createDataFrame([(k, n, 1) for k, n in enumerate(nombres)], "id int, nombre_monitor string, activo int")
    textos = ["CBA - 2022-11-01 z", "zz BA - 2022-11-02", "A - 2022-11-03 - 2022-11-04", "el ñandú - 2022-11-05\nx y - 2022-11-06", " - 2022-11-07", "B - 2022-11-08"]
    got = coverage.cobertura_etiquetas(spark.createDataFrame([(x,) for x in textos], "texto string"), progs, Period(2022, 11), 1, 8).collect()
    halladas = {(k, d) for k, n in enumerate(nombres) for d in range(1, 9) if n is not None and any(f"{n} - 2022-11-{d:02d}" in x for x in textos)}
    halladas.discard((4, 7))  # a text before the date is needed
    assert {(r.programa_id, r.fecha.day) for r in got} == {(k, d) for k in range(8) for d in range(1, 9)} - halladas


def test_validation_columns_agree_with_the_arguments(spark):
    casos = [(y, m, i, f) for y in (2016, 2017, 2024, 2049, 2050) for m in (0, 1, 2, 12, 13) for i in (0, 1, 29, 30) for f in (0, 1, 28, 29, 31)]

    def vale(f, *a):
        try:
            f(*a)
        except ValueError:
            return False
        return True

    df = spark.createDataFrame([*casos, (None, 1, 1, 1)], "y int, m int, i int, f int")
    got = df.select("y", "m", "i", "f", periodo_valido("y", "m").alias("p"), rango_valido("y", "m", F.col("i"), F.col("f")).alias("r")).collect()
    for x in got:
        if x.y is None:
            assert (x.p, x.r) == (False, False)
            continue
        assert x.p == vale(prompt_period, x.y, x.m)
        assert x.r == (1 <= x.m <= 12 and vale(lambda x=x: Period(x.y, x.m).day_range(x.i, x.f)))


def test_cubos_por_grupos_de_meses(spark, tmp_path, monkeypatch):
    """A bucket's months are joined in groups, each in tasks of its own; the rows are those of one join."""
    import uuid

    from workdays.plans import cubos
    from workdays.plans.ingest import PARTICION
    from workdays.sources import tables as t

    assert cubos._grupos({"2020-02": 3, "2020-01": 2, "2020-03": 9, "2020-04": 1}, 5) == [["2020-01", "2020-02"], ["2020-03"], ["2020-04"]]
    calls = t.llamadas(spark, "/root/testdata/sf0.001").withColumn("programa_id", F.col("programa_id").cast("int"))
    calls = calls.withColumn(PARTICION, F.date_format("fecha", "yyyy-MM"))
    sin_dia = calls.limit(3).withColumn("fecha", F.lit(None).cast("date")).withColumn(PARTICION, F.lit(None).cast("string"))
    calls = calls.unionByName(sin_dia)
    salidas = []
    for tope in (10**9, 400):
        monkeypatch.setattr(cubos, "FILAS_POR_TAREA", tope)
        nombre = f"cubos_{uuid.uuid4().hex}"
        cubos.crear(spark, nombre, str(tmp_path / nombre), 4, ["fecha", "log_name"])
        assert cubos.cargar(spark, nombre, calls.where("fecha < DATE'1996-01-01'")) > 0
        plan = cubos.nuevas(spark, nombre, calls)._jdf.queryExecution().optimizedPlan().toString()
        assert (plan.count("Join LeftOuter") > 1) == (tope == 400)
        cubos.cargar(spark, nombre, calls)
        assert cubos.cargar(spark, nombre, calls) == 3  # rows without a day never conflict
        salidas.append(sorted(map(str, spark.table(nombre).collect())))
        spark.sql(f"DROP TABLE {nombre}")
    # and the rows without a day, three a load
    assert salidas[0] == salidas[1] and len(salidas[0]) > 1000


def test_a_load_opens_only_its_months_of_the_stored_calls(spark, tmp_path):
    destino, est = f"{tmp_path}/llamadas", f"{tmp_path}/estados"
    estados.cargar(spark, destino, est, _lote(calls(spark, [llamada(D(2022, 11, 1), "ana", 17), llamada(D(2022, 12, 1), "ana", 17)])))
    for archivo in (tmp_path / "llamadas" / "anio_mes=2022-11").glob("*.parquet"):
        archivo.write_bytes(b"unreadable")
        (archivo.parent / f".{archivo.name}.crc").unlink(missing_ok=True)
    dos = _lote(calls(spark, [llamada(D(2022, 12, 1), "ana", 17), llamada(D(2022, 12, 2), "ana", 17)]))
    assert estados.cargar(spark, destino, est, dos) == 1
    estados.reconstruir(spark, destino, est, ["2022-12"])
    assert sorted((r.mes, r.n_dias) for r in estados.dias_por_agente(estados.leer(spark, destino, est)).collect()) == [(11, 1), (12, 2)]


def test_published_slices_are_listed_as_one_line_each(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(f"{i % 28 + 1}/3/2020", str(i), "" if i % 2 else "S1", "202003") for i in range(60)], "`Call day` string, `Call time` string, salida string, anio_mes string")
    vistas = []
    real = sinks._carpetas_escritas
    monkeypatch.setattr(sinks, "_carpetas_escritas", lambda *a: vistas.append(real(*a)) or vistas[-1])
    assert sinks.publicar(df.where("salida = 'S1' OR `Call time` = '1'"), f"{tmp_path}/p", filas_por_archivo=4) == 31
    assert len(vistas[0]) == 2 and vistas[0][("S1", "202003")][1] is None and vistas[0][(None, "202003")][1].endswith(".csv")
    assert (tmp_path / "p" / "202003 S1 to_access.csv").is_dir() and (tmp_path / "p" / "202003 to_access.csv").is_file()
    partes = list((tmp_path / "p" / "202003 S1 to_access.csv").glob("*.csv"))
    assert len(partes) >= 8 and all(len(x.read_text().splitlines()) <= 5 for x in partes)
    assert files.leer_delimitado(spark, f"{tmp_path}/p/?????? *to_access.csv").count() == 31
