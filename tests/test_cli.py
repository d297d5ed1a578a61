import pytest

from tests.fixtures import D, calls, dims, llamada
from tests.test_files import HDR, _write
from workdays import cli


def test_cli_end_to_end(spark, tmp_path, capsys):
    agentes, grupos, programas = dims(spark)
    for name, df in (("agentes", agentes), ("grupos", grupos), ("programas", programas)):
        df.write.parquet(str(tmp_path / name))
    origen = tmp_path / "csv"
    origen.mkdir()
    _write(origen / "202211 REL to_access.csv", HDR, [
        ["1/11/2022", "7:00:00", "1", "30", "s", "v", "ana", "r"],
        ["2/11/2022", "7:00:00", "2", "40", "s", "v", "bob", "r"],
    ])
    dest = str(tmp_path / "llamadas")
    assert cli.main(["cargar", "--origen", str(origen), "--destino", dest, "--salida-nombre", "REL",
                     "--programas", str(tmp_path / "programas")], spark) == 0
    assert "Insertados 2" in capsys.readouterr().out
    assert cli.main(["asistencia", "--llamadas", dest, "--agentes", str(tmp_path / "agentes"),
                     "--programas", str(tmp_path / "programas"), "--fecha", "2022-11-03", "--programa", "18",
                     "--agente", "ana", "--agente", "cid", "--destino", dest], spark) == 0
    assert "Insertados 2" in capsys.readouterr().out
    out = str(tmp_path / "informe")
    dims_args = ["--agentes", str(tmp_path / "agentes"), "--grupos", str(tmp_path / "grupos"),
                 "--programas", str(tmp_path / "programas")]
    assert cli.main(["informe", "--llamadas", dest, *dims_args, "--periodo", "2022-11", "--programa", "18",
                     "--presentar", "--salida", out], spark) == 0
    rows = spark.read.parquet(out).collect()
    tot = [r for r in rows if r["fila"] == "T"][0]
    assert tot["n_dias"] == "4" and tot["importe"] == "80,00" and tot["nombre_monitor"] == "-TOTAL:-->"
    assert cli.main(["media", "--llamadas", dest, "--programa", "18", "--salida", str(tmp_path / "m")], spark) == 0
    m = {r["log_name"]: r["num_llamadas"] for r in spark.read.parquet(str(tmp_path / "m")).collect()}
    assert m == {"ana": 2, "bob": 1, "cid": 1}
    assert cli.main(["cobertura", "--llamadas", dest, "--programas", str(tmp_path / "programas"),
                     "--periodo", "2022-11", "--desde", "1", "--hasta", "3", "--salida", str(tmp_path / "c")], spark) == 0
    falta = {(r["programa_id"], r["fecha"].day) for r in spark.read.parquet(str(tmp_path / "c")).collect()}
    assert falta == {(17, 1), (17, 2), (17, 3)}


@pytest.mark.parametrize("forma", [[], ["--carpetas"]])
def test_cli_consolidate_then_load(spark, tmp_path, capsys, forma):
    _, _, programas = dims(spark)
    programas.write.parquet(str(tmp_path / "programas"))
    ex = tmp_path / "exports"
    ex.mkdir()
    _write(ex / "20221101 REL multioption_monitor_08_53_14.csv", HDR, [["1/11/2022", "7:00:00", "1", "30", "s", "v", "ana", "r"]])
    _write(ex / "20221102 REL multioption_monitor_08_53_14.csv", HDR, [["2/11/2022", "7:00:00", "1", "30", "s", "v", "ana", "r"]])
    cons = str(tmp_path / "consolidado")
    assert cli.main(["consolidar", "--origen", str(ex), "--periodo", "2022-11", "--salida-nombre", "REL",
                     "--destino", cons, *forma], spark) == 0
    assert "Escritos 2" in capsys.readouterr().out
    dest = str(tmp_path / "llamadas")
    assert cli.main(["cargar", "--origen", cons, *forma, "--salida-nombre", "REL", "--destino", dest,
                     "--programas", str(tmp_path / "programas")], spark) == 0
    assert "Insertados 2" in capsys.readouterr().out
    assert {r["programa_id"] for r in spark.read.parquet(dest).collect()} == {18}


def test_cli_three_reports(spark, tmp_path):
    agentes, grupos, programas = dims(spark)
    for name, df in (("agentes", agentes), ("grupos", grupos), ("programas", programas)):
        df.write.parquet(str(tmp_path / name))
    rows = [llamada(D(2022, 11, 1), "ana", 17), llamada(D(2022, 11, 2), "ana", 17), llamada(D(2022, 11, 1), "bob", 17)]
    calls(spark, rows).write.parquet(str(tmp_path / "llamadas"))
    out = str(tmp_path / "inf")
    assert cli.main(["informe", "--tipo", "todos", "--llamadas", str(tmp_path / "llamadas"),
                     "--agentes", str(tmp_path / "agentes"), "--grupos", str(tmp_path / "grupos"),
                     "--programas", str(tmp_path / "programas"), "--periodo", "2022-11", "--programa", "17",
                     "--presentar", "--salida", out], spark) == 0
    assert spark.read.parquet(f"{out}/agente").count() == 2
    tot = spark.read.parquet(f"{out}/total").where("fila = 'T'").first()
    assert tot["n_dias"] == "3" and tot["importe"] == "31,50"
    assert spark.read.parquet(f"{out}/grupo").where("fila = 'D'").count() == 1


def test_cli_replays_the_quarantine(spark, tmp_path, capsys):
    programas = "id int, nombre_salida string, activo int"
    spark.createDataFrame([(18, "REL", 1), (19, "REL", 1)], programas).write.parquet(str(tmp_path / "p1"))
    spark.createDataFrame([(18, "REL", 1), (19, "REL", 0)], programas).write.parquet(str(tmp_path / "p2"))
    src = tmp_path / "in"
    src.mkdir()
    _write(src / "202211 REL to_access.csv", HDR, [["1/11/2022", "7:00:00", "1", "30", "s", "v", "ana", "r"]])
    dest, q = str(tmp_path / "llamadas"), str(tmp_path / "q")
    base = ["cargar", "--origen", str(src), "--salida-nombre", "REL", "--destino", dest, "--cuarentena", q]
    assert cli.main([*base, "--programas", str(tmp_path / "p1")], spark) == 0
    assert "Insertados 0 registros; en cuarentena 1" in capsys.readouterr().out
    assert cli.main(["reprocesar", "--destino", dest, "--cuarentena", q, "--programas", str(tmp_path / "p2")], spark) == 0
    assert "Insertados 1 registros; en cuarentena 0" in capsys.readouterr().out
    assert {r["programa_id"] for r in spark.read.parquet(dest).collect()} == {18}
