"""Random inputs against plain-Python implementations of the same semantics."""

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.fixtures import calls, dims, reglas
from workdays.model import Period
from workdays.operators.load import insertar_ignorando
from workdays.plans import coverage, reports

NAMES = ["ana", "bob", "cid", "dan", "eve", "zoe", None]
PROGS = [17, 18, 19]
DAYS = [dt.date(2022, 10, 30), dt.date(2022, 11, 1), dt.date(2022, 11, 2), dt.date(2022, 11, 30), dt.date(2022, 12, 1)]

call = st.tuples(
    st.sampled_from(DAYS), st.sampled_from(["10:00:00", "11:00:00"]), st.sampled_from(["1", "2"]),
    st.one_of(st.none(), st.integers(-5, 500)), st.none(), st.none(), st.sampled_from(NAMES), st.just("r"),
    st.sampled_from(PROGS),
)
rule = st.tuples(st.sampled_from(PROGS), st.sampled_from(["2022-10", "2022-11", "2022-12"]), st.sampled_from(NAMES[:-1]))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _slice(d):
    return d.year, d.month


def brute_r1(rows, rules=()):
    ruled = {(p, m) for p, m, _ in rules}
    excl = {(p, m, n) for p, m, n in rules}
    days = defaultdict(set)
    for f, _, _, _, _, _, n, _, p in rows:
        m = f"{f.year:04d}-{f.month:02d}"
        if (p, m, n) in excl or ((p, m) in ruled and n is None):
            continue
        days[(p, f.year, f.month, n)].add(f)
    return {k: len(v) for k, v in days.items()}


@SETTINGS
@given(st.lists(call, max_size=40), st.lists(rule, max_size=4))
def test_r1_and_rules(spark, rows, rules):
    df = reports.dias_por_agente(calls(spark, rows), reglas=reglas(spark, rules) if rules else None)
    got = {(r.programa_id, r.anio, r.mes, r.log_name): r.n_dias for r in df.collect()}
    assert got == brute_r1(rows, rules)


@SETTINGS
@given(st.lists(call, max_size=40))
def test_r2_r3(spark, rows):
    agentes, grupos, programas = dims(spark)
    ag = {r.log_name: (r.nombre, r.grupo) for r in agentes.collect()}
    gr = {r.grupo for r in grupos.collect()}
    rate = {r.id: r.factura_hora for r in programas.collect()}
    r1 = brute_r1(rows)
    det = {k: v for k, v in r1.items() if k[3] in ag and ag[k[3]][1] in gr and k[0] in rate}
    tot = defaultdict(lambda: [0, Decimal("0")])
    for (p, y, m, n), v in det.items():
        tot[(p, y, m)][0] += v
        tot[(p, y, m)][1] += v * rate[p]
    c = calls(spark, rows)
    r2 = reports.dias_con_total(c, agentes, grupos, programas).collect()
    assert {(r.programa_id, r.anio, r.mes, r.log_name): r.n_dias for r in r2 if r.fila == "D"} == det
    assert {(r.programa_id, r.anio, r.mes): [r.n_dias, r.importe] for r in r2 if r.fila == "T"} == dict(tot)
    by_group = defaultdict(int)
    for (p, y, m, n), v in det.items():
        by_group[(p, y, m, ag[n][1])] += v
    r3 = reports.dias_por_grupo(c, agentes, grupos, programas).collect()
    assert {(r.programa_id, r.anio, r.mes, r.grupo): r.n_dias for r in r3 if r.fila == "D"} == dict(by_group)


@SETTINGS
@given(st.lists(call, max_size=40))
def test_r4(spark, rows):
    acc = defaultdict(lambda: [0, 0, 0])
    for f, _, _, dur, _, _, n, _, p in rows:
        if not (f >= dt.date(2022, 11, 1) and f < dt.date(2022, 12, 1)):
            continue
        a = acc[(p, n)]
        a[2] += 1
        if dur is not None:
            a[0] += dur
            a[1] += 1
    want = {}
    for k, (s, nd, nc) in acc.items():
        mean = None if nd == 0 else int(s / nd) if s * nd >= 0 else -(abs(s) // nd)
        want[k] = (mean, s if nd else None, nc)
    df = reports.media_por_agente(calls(spark, rows), period=Period(2022, 11))
    got = {(r.programa_id, r.log_name): (r.media_seg, r.tot_sec, r.num_llamadas) for r in df.collect()}
    assert got == want


key_row = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b"]), st.sampled_from(["x", "y", "z"]), st.integers(0, 2))


@SETTINGS
@given(st.lists(key_row, max_size=30), st.lists(key_row, max_size=30))
def test_insert_ignore(spark, target, batch):
    schema = "k1 int, k2 string, v string, w int"
    tdf = spark.createDataFrame(target, schema)
    bdf = spark.createDataFrame(batch, schema)
    got = sorted(map(tuple, insertar_ignorando(tdf, bdf, ["k1", "k2"]).collect()), key=repr)
    existing = {(a, b) for a, b, _, _ in target if a is not None}
    first = {}
    nulls = []
    for r in batch:
        if r[0] is None:
            nulls.append(r)
        elif (r[0], r[1]) not in existing:
            k = (r[0], r[1])
            first[k] = min(first.get(k, r), r, key=lambda x: (x[2], x[3]))
    want = sorted(list(first.values()) + nulls, key=repr)
    assert got == want
    # loading the result and the batch again adds nothing but NULL-key rows
    again = insertar_ignorando(tdf.unionByName(insertar_ignorando(tdf, bdf, ["k1", "k2"])), bdf, ["k1", "k2"])
    assert again.count() == len(nulls)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([1, 2]), st.sampled_from(DAYS)), max_size=15))
def test_coverage_partition(spark, got):
    df = spark.createDataFrame(got, "programa_id int, fecha date")
    out = {(r.programa_id, r.fecha) for r in coverage.cobertura(df).collect()}
    seen = set(got)
    for p in {p for p, _ in got}:
        ds = [d for q, d in got if q == p]
        lo, hi = min(ds).replace(day=1), max(ds)
        hi = (hi.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        spine = {(p, lo + dt.timedelta(days=i)) for i in range((hi - lo).days + 1)}
        assert {x for x in out if x[0] == p} == spine - seen


@SETTINGS
@given(st.lists(call, max_size=40))
def test_days_across_programmes_and_global_total(spark, rows):
    agentes, grupos, programas = dims(spark)
    ag = {r.log_name: r.grupo for r in agentes.collect()}
    gr = {r.grupo for r in grupos.collect()}
    rate = {r.id: r.factura_hora for r in programas.collect()}
    c = calls(spark, rows)
    days = defaultdict(set)
    for f, _, _, _, _, _, n, _, p in rows:
        if dt.date(2022, 11, 1) <= f < dt.date(2022, 12, 1):
            days[n].add(f)
    got = {r.log_name: r.n_dias for r in reports.dias_por_agente(c, period=Period(2022, 11), por_programa=False).collect()}
    assert got == {n: len(v) for n, v in days.items()}
    det = {k: v for k, v in brute_r1(rows).items() if (k[1], k[2]) == (2022, 11) and k[3] in ag and ag[k[3]] in gr}
    r2 = reports.dias_con_total(c, agentes, grupos, programas, period=Period(2022, 11), total="global").collect()
    (tot,) = [r for r in r2 if r.fila == "T"]
    progs = {k[0] for k in det}
    assert tot.n_dias == (sum(det.values()) if det else None)
    assert tot.importe == (sum(v * rate[k[0]] for k, v in det.items()) if det else None)
    assert tot.programa_id == (next(iter(progs)) if len(progs) == 1 else None)


presence = st.tuples(st.sampled_from(DAYS), st.sampled_from(PROGS + [99]), st.sampled_from(NAMES[:-1] + ["nobody"]))


@SETTINGS
@given(st.lists(call, max_size=30), st.lists(presence, max_size=15), st.booleans())
def test_attendance(spark, rows, pres, any_programme):
    from workdays.plans import attendance

    agentes, _, programas = dims(spark)
    known = {r.log_name for r in agentes.collect()}
    hora = {r.id: r.hora_fin for r in programas.collect()}
    had = {(f, p, n) for f, _, _, _, _, _, n, _, p in rows}
    had_any = {(f, n) for f, _, _, _, _, _, n, _, _ in rows}
    want = set()
    for f, p, n in pres:
        if n in known and p in hora:
            busy = (f, n) in had_any if any_programme else (f, p, n) in had
            if not busy:
                want.add((f, hora[p], n, p))
    pdf = spark.createDataFrame(pres, "fecha date, programa_id int, log_name string")
    out = attendance.asistencia(calls(spark, rows), agentes, programas, pdf, en_cualquier_programa=any_programme)
    assert {(r.fecha, r.hora, r.log_name, r.programa_id) for r in out.collect()} == want
    assert all(r.dur == 0 for r in out.collect())
