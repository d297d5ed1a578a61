from decimal import Decimal

from pyspark.sql import functions as F

from tests.fixtures import D, calls, dims, llamada, reglas
from workdays.model import PLACEHOLDER_CALLER, Period
from workdays.plans import reports

NOV = Period(2022, 11)


def _rows(spark):
    return [
        llamada(D(2022, 11, 1), "ana", 17),
        llamada(D(2022, 11, 1), "ana", 17, hora="11:00:00"),  # same day twice: one day
        llamada(D(2022, 11, 2), "ana", 17),
        llamada(D(2022, 11, 2), "ana", 18),  # same day, other programme (D12)
        llamada(D(2022, 11, 1), "bob", 17),
        llamada(D(2022, 11, 3), "cid", 17),
        llamada(D(2022, 11, 3), "dan", 17),
        llamada(D(2022, 11, 4), "eve", 17),  # group missing -> dropped by R2/R3
        llamada(D(2022, 11, 4), "zoe", 17),  # not an agent -> kept by R1 only (D19)
        llamada(D(2022, 11, 5), None, 17),  # NULL name
        llamada(D(2022, 12, 1), "ana", 17),  # other month
    ]


def _by(df, *cols):
    return {tuple(r[c] for c in cols[:-1]): r[cols[-1]] for r in df.collect()}


def test_r1_counts_distinct_days_per_slice(spark):
    r1 = reports.dias_por_agente(calls(spark, _rows(spark)), period=NOV, programa=17)
    got = _by(r1, "log_name", "n_dias")
    assert got == {("ana",): 2, ("bob",): 1, ("cid",): 1, ("dan",): 1, ("eve",): 1, ("zoe",): 1, (None,): 1}


def test_r1_all_programmes_and_months(spark):
    r1 = reports.dias_por_agente(calls(spark, _rows(spark)))
    got = _by(r1, "programa_id", "anio", "mes", "log_name", "n_dias")
    assert got[(17, 2022, 11, "ana")] == 2
    assert got[(18, 2022, 11, "ana")] == 1
    assert got[(17, 2022, 12, "ana")] == 1


def test_r2_detail_and_total(spark):
    agentes, grupos, programas = dims(spark)
    r2 = reports.dias_con_total(calls(spark, _rows(spark)), agentes, grupos, programas, period=NOV, programa=17)
    det = {r["log_name"]: r for r in r2.where("fila = 'D'").collect()}
    assert set(det) == {"ana", "bob", "cid", "dan"}  # eve (no group), zoe (no agent), NULL dropped
    assert det["ana"]["n_dias"] == 2 and det["ana"]["importe"] == Decimal("21.00")
    assert det["ana"]["tarifa"] == Decimal("10.50") and det["ana"]["nombre_monitor"] == "ANILLOS"
    (tot,) = r2.where("fila = 'T'").collect()
    assert tot["n_dias"] == 5 and tot["importe"] == Decimal("52.50")
    assert tot["log_name"] is None and tot["tarifa"] == Decimal("10.50")


def test_total_is_sum_of_detail_property(spark):
    agentes, grupos, programas = dims(spark)
    r2 = reports.dias_con_total(calls(spark, _rows(spark)), agentes, grupos, programas)
    det = r2.where("fila = 'D'").groupBy("programa_id", "anio", "mes").agg(
        F.sum("n_dias").alias("n"), F.sum("importe").alias("i")
    )
    tot = r2.where("fila = 'T'").select("programa_id", "anio", "mes", F.col("n_dias").alias("n"), F.col("importe").alias("i"))
    assert sorted(map(tuple, det.collect())) == sorted(map(tuple, tot.collect()))


def test_empty_slice_still_has_total_row(spark):
    agentes, grupos, programas = dims(spark)
    r2 = reports.dias_con_total(
        calls(spark, _rows(spark)), agentes, grupos, programas, period=Period(2023, 1), programa=17
    )
    rows = r2.collect()
    assert len(rows) == 1 and rows[0]["fila"] == "T"
    assert rows[0]["n_dias"] is None and rows[0]["importe"] is None


def test_r3_groups_equal_figures_both_kept(spark):
    agentes, grupos, programas = dims(spark)
    r3 = reports.dias_por_grupo(calls(spark, _rows(spark)), agentes, grupos, programas, period=NOV, programa=17)
    det = r3.where("fila = 'D'").collect()
    # groups 2 and 3 share description and figures: UNION ALL keeps both
    noche = [r for r in det if r["grupo_desc"] == "Noche"]
    assert len(noche) == 2 and {r["n_dias"] for r in noche} == {1}
    manana = [r for r in det if r["grupo_desc"] == "Mañana"][0]
    assert manana["n_dias"] == 3  # ana 2 + bob 1 agent-days
    (tot,) = r3.where("fila = 'T'").collect()
    assert tot["n_dias"] == sum(r["n_dias"] for r in det)


def test_r3_total_equals_r2_total(spark):
    agentes, grupos, programas = dims(spark)
    c = calls(spark, _rows(spark))
    t2 = reports.dias_con_total(c, agentes, grupos, programas).where("fila='T'").select("programa_id", "anio", "mes", "n_dias", "importe")
    t3 = reports.dias_por_grupo(c, agentes, grupos, programas).where("fila='T'").select("programa_id", "anio", "mes", "n_dias", "importe")
    assert sorted(map(tuple, t2.collect())) == sorted(map(tuple, t3.collect()))


def test_rules_exclude_agents_and_null_names(spark):
    c = calls(spark, _rows(spark))
    rules = reglas(spark, [(17, "2022-11", "ana"), (17, "2022-11", "bob")])
    r5 = reports.dias_por_agente(c, period=NOV, programa=17, reglas=rules)
    names = {r["log_name"] for r in r5.collect()}
    assert names == {"cid", "dan", "eve", "zoe"}  # NULL name dropped too (D8)
    # a slice without rules keeps its NULL names
    c2 = calls(spark, [llamada(D(2022, 11, 5), None, 18)])
    assert reports.dias_por_agente(c2, reglas=rules).count() == 1


def test_rules_in_other_month_do_nothing(spark):
    c = calls(spark, _rows(spark))
    rules = reglas(spark, [(17, "2022-12", "ana")])
    r5 = reports.dias_por_agente(c, period=NOV, programa=17, reglas=rules)
    assert r5.count() == 7


def test_case_and_trailing_space_names_are_distinct(spark):
    c = calls(spark, [llamada(D(2022, 11, 1), "ana", 17), llamada(D(2022, 11, 1), "Ana ", 17)])
    assert reports.dias_por_agente(c).count() == 2


def test_r4_mean_truncated_and_clock(spark):
    rows = [
        llamada(D(2022, 11, 1), "ana", 17, dur=10),
        llamada(D(2022, 11, 2), "ana", 17, dur=11, hora="11:00:00"),
        llamada(D(2022, 11, 2), "ana", 17, dur=None, hora="12:00:00"),
        llamada(D(2022, 12, 2), "ana", 17, dur=4000),
        llamada(D(2022, 11, 2), "bob", 17, dur=-7),
        llamada(D(2022, 11, 2), "bob", 17, dur=0, hora="23:00:00", llamante=PLACEHOLDER_CALLER),
    ]
    c = calls(spark, rows)
    r4 = {r["log_name"]: r for r in reports.media_por_agente(c, period=NOV, programa=17).collect()}
    assert r4["ana"]["media_seg"] == 10 and r4["ana"]["tot_sec"] == 21 and r4["ana"]["num_llamadas"] == 3
    assert r4["ana"]["dur_media"] == "00:00:10"
    assert r4["bob"]["media_seg"] == -3  # -7 div 2 truncates toward zero
    serie = {r["log_name"]: r for r in reports.media_por_agente(c, programa=17).collect()}
    assert serie["ana"]["tot_sec"] == 4021 and serie["ana"]["dur_media"] == "00:22:20"
    sin = {r["log_name"]: r for r in reports.media_por_agente(c, programa=17, excluir_marcadores=True).collect()}
    assert sin["bob"]["num_llamadas"] == 1 and sin["bob"]["media_seg"] == -7
    ordered = [r["log_name"] for r in reports.media_por_agente(c, programa=17, ordenar=True).collect()]
    assert ordered == ["bob", "ana"]


def test_r4_monthly_keys(spark):
    c = calls(spark, [llamada(D(2022, 11, 1), "ana", 17, dur=10), llamada(D(2022, 12, 1), "ana", 17, dur=20)])
    r = reports.media_por_agente(c, mensual=True)
    assert r.columns[:4] == ["programa_id", "anio", "mes", "log_name"]
    assert r.count() == 2


def test_placeholders_count_as_days_unless_excluded(spark):
    rows = [llamada(D(2022, 11, 1), "ana", 17, dur=0, llamante=PLACEHOLDER_CALLER), llamada(D(2022, 11, 2), "ana", 17)]
    c = calls(spark, rows)
    assert reports.dias_por_agente(c).first()["n_dias"] == 2
    assert reports.dias_por_agente(c, excluir_marcadores=True).first()["n_dias"] == 1


def test_ordered_output_puts_total_last(spark):
    agentes, grupos, programas = dims(spark)
    r2 = reports.dias_con_total(calls(spark, _rows(spark)), agentes, grupos, programas, period=NOV, programa=17, ordenar=True)
    filas = [(r["fila"], r["grupo"], r["log_name"]) for r in r2.collect()]
    assert filas[-1][0] == "T"
    assert filas[:-1] == sorted(filas[:-1], key=lambda x: (x[1], x[2]))


def test_collation_merges_case_and_trailing_space(spark):
    rows = [llamada(D(2022, 11, 1), "ana", 17), llamada(D(2022, 11, 1), "Ana ", 17), llamada(D(2022, 11, 2), "ANA", 17)]
    c = calls(spark, rows)
    assert reports.dias_por_agente(c).count() == 3  # binary by default
    r = reports.dias_por_agente(c, colacion="UTF8_LCASE_RTRIM").collect()
    assert len(r) == 1 and r[0]["n_dias"] == 2 and r[0]["log_name"].rstrip().lower() == "ana"
    agentes, grupos, programas = dims(spark)
    r2 = reports.dias_con_total(c, agentes, grupos, programas, colacion="UTF8_LCASE_RTRIM")
    (tot,) = r2.where("fila = 'T'").collect()
    assert tot["n_dias"] == 2
    rules = reglas(spark, [(17, "2022-11", "ANA")])
    assert reports.dias_por_agente(c, reglas=rules, colacion="UTF8_LCASE_RTRIM").count() == 0
    m = reports.media_por_agente(c, colacion="UTF8_LCASE_RTRIM").collect()
    assert len(m) == 1 and m[0]["num_llamadas"] == 3


def test_repeated_dimension_keys_do_not_duplicate_rows(spark):
    agentes, grupos, programas = dims(spark)
    agentes2 = agentes.unionByName(spark.createDataFrame([("ana", "Ana Bis", 2, 1)], agentes.schema))
    programas2 = programas.unionByName(programas.where("id = 17"))
    c = calls(spark, _rows(spark))
    r2 = reports.dias_con_total(c, agentes2, grupos, programas2, period=NOV, programa=17)
    det = r2.where("fila = 'D' AND log_name = 'ana'").collect()
    assert len(det) == 1 and det[0]["n_dias"] == 2 and det[0]["nombre"] == "Ana"  # first by (grupo, nombre)
    (tot,) = r2.where("fila = 'T'").collect()
    assert tot["n_dias"] == 5 and tot["importe"] == Decimal("52.50")
    # in R3 the agent listed under two groups counts in both groups
    r3 = {r["grupo"]: r["n_dias"] for r in reports.dias_por_grupo(c, agentes2, grupos, programas2, period=NOV, programa=17).where("fila='D'").collect()}
    assert r3 == {1: 3, 2: 3, 3: 1}


def test_presentation_titles(spark):
    from workdays.functions.present import presentar

    agentes, grupos, programas = dims(spark)
    c = calls(spark, _rows(spark))
    r2 = presentar(reports.dias_con_total(c, agentes, grupos, programas, period=NOV, programa=17), titulos=True)
    assert r2.columns == ["programa_id", "fila", "Año", "Mes", "Nombre", "Agente", "Programa", "€/día", "Núm. Días", "Total €"]
    tot = r2.where("fila = 'T'").first()
    assert (tot["Agente"], tot["Programa"], tot["Total €"]) == ("-----", "-TOTAL:-->", "52,50")
    r3 = presentar(reports.dias_por_grupo(c, agentes, grupos, programas, period=NOV, programa=17), titulos=True)
    assert r3.columns[2:] == ["Año", "Mes", "Grupo", "Programa", "€/día", "Total d.", "Total €"]


def test_three_reports_from_one_reading(spark):
    agentes, grupos, programas = dims(spark)
    c = calls(spark, _rows(spark))
    r1, r2, r3 = reports.informes_dias(c, agentes, grupos, programas, period=NOV, programa=17)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(r1) == key(reports.dias_por_agente(c, period=NOV, programa=17))
    assert key(r2) == key(reports.dias_con_total(c, agentes, grupos, programas, period=NOV, programa=17))
    assert key(r3) == key(reports.dias_por_grupo(c, agentes, grupos, programas, period=NOV, programa=17))
    assert "ExistingRDD" in r2._jdf.queryExecution().executedPlan().toString()  # reads the checkpoint


def test_global_total_and_days_across_programmes(spark):
    agentes, grupos, programas = dims(spark)
    c = calls(spark, _rows(spark))
    r2 = reports.dias_con_total(c, agentes, grupos, programas, period=NOV, total="global")
    (tot,) = r2.where("fila = 'T'").collect()
    det = r2.where("fila = 'D'").collect()
    assert tot["n_dias"] == sum(r["n_dias"] for r in det) == 6  # ana 2+1 (two programmes), bob, cid, dan
    assert tot["programa_id"] is None and tot["tarifa"] is None  # several programmes (D14)
    assert (tot["anio"], tot["mes"]) == (2022, 11)
    empty = reports.dias_con_total(c, agentes, grupos, programas, period=Period(2023, 1), total="global").collect()
    assert len(empty) == 1 and empty[0]["n_dias"] is None  # one total row even with no calls (D10)
    # days worked in any programme: ana worked 2 days although she has 3 programme-days
    r1 = {r["log_name"]: r["n_dias"] for r in reports.dias_por_agente(c, period=NOV, por_programa=False).collect()}
    assert r1["ana"] == 2 and "programa_id" not in reports.dias_por_agente(c, por_programa=False).columns


def test_rules_for_every_programme(spark):
    c = calls(spark, _rows(spark))
    rules = reglas(spark, [(None, "2022-11", "ana")])
    got = {(r["programa_id"], r["log_name"]) for r in reports.dias_por_agente(c, period=NOV, reglas=rules).collect()}
    assert (17, "ana") not in got and (18, "ana") not in got and (17, "bob") in got
    assert (17, None) not in got  # NULL names dropped in ruled months (D8)
