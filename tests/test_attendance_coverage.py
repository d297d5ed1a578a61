import pytest
from pyspark.sql import functions as F

from tests.fixtures import D, calls, dims, llamada
from workdays.model import PLACEHOLDER_CALLER, PLACEHOLDER_RESULT, Period, prompt_period
from workdays.operators.load import insertar_ignorando
from workdays.plans import attendance, coverage


def test_attendance_rows(spark):
    agentes, _, programas = dims(spark)
    out = attendance.asistencia_dia(spark, agentes, programas, "2022-11-05", 17, ["ana", "bob", "nobody"])
    rows = sorted(out.collect(), key=lambda r: r["log_name"])
    assert [r["log_name"] for r in rows] == ["ana", "bob"]  # unknown agent gets no row
    r = rows[0]
    assert (r["fecha"], r["hora"], r["llamante"], r["dur"], r["resultado"], r["programa_id"]) == (
        D(2022, 11, 5), "23:00:00", PLACEHOLDER_CALLER, 0, PLACEHOLDER_RESULT, 17)
    assert r["station"] is None and r["voice_file"] is None
    assert out.columns == attendance.COLUMNS


def test_attendance_empty_list_and_unknown_programme(spark):
    agentes, _, programas = dims(spark)
    assert attendance.asistencia_dia(spark, agentes, programas, "2022-11-05", 17, []).count() == 0
    assert attendance.asistencia_dia(spark, agentes, programas, "2022-11-05", 99, ["ana"]).count() == 0


def test_attendance_skips_agents_with_calls_and_registers_once(spark):
    agentes, _, programas = dims(spark)
    c = calls(spark, [llamada(D(2022, 11, 5), "ana", 17)])
    out = attendance.asistencia_dia(spark, agentes, programas, "2022-11-05", 17, ["ana", "bob"], calls=c)
    assert [r["log_name"] for r in out.collect()] == ["bob"]
    # registered twice through the insert-ignore load: the second time adds nothing
    key = ["fecha", "hora", "llamante", "log_name", "programa_id"]
    first = insertar_ignorando(c, out, key)
    table = c.unionByName(first)
    assert first.count() == 1 and insertar_ignorando(table, out, key).count() == 0


def test_coverage_month_window(spark):
    _, _, programas = dims(spark)
    got = spark.createDataFrame([(17, D(2022, 11, d)) for d in (1, 2, 4)], "programa_id int, fecha date")
    out = coverage.cobertura(got, programas, period=Period(2022, 11), d_ini=1, d_fin=5)
    rows = sorted((r["programa_id"], r["fecha"].day) for r in out.collect())
    assert rows == [(17, 3), (17, 5)] + [(18, d) for d in range(1, 6)]  # 19 is inactive
    lab = out.where("programa_id = 17 AND fecha = DATE'2022-11-03'").first()["etiqueta"]
    assert lab == "ANILLOS - 2022-11-03"


def test_coverage_union_with_received_is_spine(spark):
    got = spark.createDataFrame(
        [(1, D(2024, 2, 3)), (1, D(2024, 3, 30)), (2, D(2023, 12, 31))], "programa_id int, fecha date"
    )
    out = coverage.cobertura(got)
    spine = out.select("programa_id", "fecha").unionByName(got)
    n1 = spine.where("programa_id = 1").distinct().count()
    assert n1 == 29 + 31  # Feb 2024 (leap) + Mar 2024
    assert spine.where("programa_id = 2").distinct().count() == 31
    assert out.where("programa_id = 1").count() == n1 - 2


@pytest.mark.parametrize("ini,fin", [(0, 5), (5, 3), (1, 31), (31, 31)])
def test_day_range_validation(ini, fin):
    with pytest.raises(ValueError):
        Period(2023, 2).day_range(ini, fin)


def test_period_validation():
    assert Period(2024, 2).days == 29 and Period(2023, 2).days == 28
    assert Period.parse("2022-11") == Period(2022, 11) == Period.parse("202211")
    with pytest.raises(ValueError):
        Period(2022, 13)
    with pytest.raises(ValueError):
        prompt_period(2016, 5)
    with pytest.raises(ValueError):
        prompt_period(2050, 5)
    assert prompt_period("2022", "11") == Period(2022, 11)


def test_labels_contained_in_texts(spark):
    texts = ["ANILLOS - 2022-11-05", "a\nRELOJ - 2022-11-07\nb", "c\nOLD - 2022-11-08 y\nB - 2022-11-09", "Emisión RELOJ - 2022-11-05 (12)", "A - B - 2022-11-06 x", "nada", "ANILLOS - 2022-13-40"]
    df = spark.createDataFrame([(x,) for x in texts], "texto string")
    found = [(r.pre, r.fecha) for r in coverage.prefijos_en_textos(df).collect()]
    labels = [("ANILLOS", D(2022, 11, 5)), ("RELOJ", D(2022, 11, 5)), ("Emisión RELOJ", D(2022, 11, 5)),
              ("A - B", D(2022, 11, 6)), ("B", D(2022, 11, 6)), ("OLD", D(2022, 11, 5)), ("RELOJ", D(2022, 11, 7)), ("OLD", D(2022, 11, 8)), ("B", D(2022, 11, 9)), ("ANILLOS", D(2022, 11, 6))]
    for m, d in labels:
        want = any(f"{m} - {d.isoformat()}" in x for x in texts)
        assert any(pre.endswith(m) and day == d for pre, day in found) == want, (m, d)


def test_label_coverage(spark):
    _, _, programas = dims(spark)
    df = spark.createDataFrame([("x ANILLOS - 2022-11-01 y",), ("RELOJ - 2022-11-02",)], "texto string")
    out = coverage.cobertura_etiquetas(df, programas, Period(2022, 11), 1, 2)
    assert sorted((r.programa_id, r.fecha.day, r.etiqueta) for r in out.collect()) == [
        (17, 2, "ANILLOS - 2022-11-02"), (18, 1, "RELOJ - 2022-11-01")]
