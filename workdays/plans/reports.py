"""Days-worked and billing reports (R1-R5) and handling time.

The reference runs each report for one programme and one month. Here a report
covers every programme and month in one job; each (programa_id, anio, mes)
"slice" gets exactly the rows the reference would print for it. Passing
``programa`` and/or ``period`` narrows the job to what the reference runs.

Plan shape shared by R1-R3: the days an agent worked in a month are one whole number with a bit
for each day, merged with ``bit_or`` (map-side first), so the calls are reduced in one shuffle
to one row for each agent, programme and month, whatever an agent's number of calls. Dimension
joins run after that reduction; Spark's size statistics choose their form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.present import seg_a_hora
from ..model import MONEY, PLACEHOLDER_CALLER, RATE, Period
from ..operators.filters import aplicar_reglas, de_programa, en_periodo
from ..session import ensure_checkpoint_dir

SLICE = ["programa_id", "anio", "mes"]


def con_colacion(df: DataFrame | None, colacion: str | None, col: str = "log_name") -> DataFrame | None:
    """Compare agent names under a collation, e.g. ``UTF8_LCASE_RTRIM`` (case and
    trailing spaces ignored). Grouping and joins then use the collation key; the
    name shown for a group is one of its equivalent spellings. ``None`` keeps
    binary comparison.
    """
    if df is None or colacion is None:
        return df
    return df.withColumn(col, F.collate(F.col(col), colacion))


def _filtrar(
    calls: DataFrame,
    period: Period | None,
    programa: object | None,
    reglas: DataFrame | None,
    excluir_marcadores: bool,
    colacion: str | None = None,
) -> DataFrame:
    df = con_colacion(de_programa(en_periodo(calls, period), programa), colacion)
    reglas = con_colacion(reglas, colacion)
    if excluir_marcadores:
        # Attendance placeholders count as days unless asked otherwise.
        df = df.where(~((F.col("dur") == 0) & (F.col("llamante") == PLACEHOLDER_CALLER)))
    return aplicar_reglas(df, reglas)


def dias_agente(
    calls: DataFrame,
    period: Period | None = None,
    programa: object | None = None,
    reglas: DataFrame | None = None,
    excluir_marcadores: bool = False,
    colacion: str | None = None,
    por_programa: bool = True,
) -> DataFrame:
    """A1: distinct (programa_id, log_name, fecha) after the filters.

    ``por_programa=False`` drops the programme: distinct (log_name, fecha), the
    days an agent worked in any programme (D12: not the sum over programmes).
    """
    df = _filtrar(calls, period, programa, reglas, excluir_marcadores, colacion)
    cols = ["programa_id", "log_name", "fecha"] if por_programa else ["log_name", "fecha"]
    return df.select(*cols).distinct()


def mapa_de_dias(fecha: str = "fecha"):
    """Days of a month as a set of bits (bit ``d`` for day ``d``): an aggregate that merges with ``bit_or``.

    NULL when no row has a date.
    """
    return F.bit_or(F.expr(f"shiftleft(1L, day({fecha}))"))


def dias_en_mapa(mapa: str = "mapa"):
    """Number of days in a set of day bits; NULL is no day."""
    return F.coalesce(F.bit_count(mapa), F.lit(0)).cast("bigint")


def dias_por_agente(
    calls: DataFrame,
    period: Period | None = None,
    programa: object | None = None,
    reglas: DataFrame | None = None,
    excluir_marcadores: bool = False,
    colacion: str | None = None,
    por_programa: bool = True,
) -> DataFrame:
    """R1 (and R5 with ``reglas``): distinct days per agent and slice.

    Columns: programa_id, anio, mes, log_name, n_dias (no programa_id with
    ``por_programa=False``). No dimension join, so names missing from the
    agents table are counted (D19).
    """
    df = _filtrar(calls, period, programa, reglas, excluir_marcadores, colacion)
    keys = (["programa_id"] if por_programa else []) + [
        F.year("fecha").alias("anio"),
        F.month("fecha").alias("mes"),
        "log_name",
    ]
    meses = df.groupBy(*keys).agg(mapa_de_dias().alias("mapa"))
    return meses.select(*meses.columns[:-1], dias_en_mapa().alias("n_dias"))


def _programas_tarifa(programas: DataFrame) -> DataFrame:
    """One row per programme id (the first by monitor name and rate if an id repeats)."""
    p = programas.select(
        F.col("id").alias("programa_id"),
        F.struct("nombre_monitor", F.col("factura_hora").cast(RATE).alias("tarifa")).alias("_p"),
    )
    p = p.groupBy("programa_id").agg(F.min("_p").alias("_p")).select("programa_id", "_p.*")
    # a task holds its programmes, not its agents' rows sorted by programme; totals then need no further shuffle
    return p.hint("shuffle_hash")


def _agentes_con_grupo(agentes: DataFrame, grupos: DataFrame) -> DataFrame:
    """Agents whose group exists (J2), with the group description.

    Repeated keys are resolved by the callers' single aggregation (per agent, or
    per agent and group), so no separate pass over the groups runs."""
    return agentes.select("log_name", "nombre", "grupo").join(
        grupos.select("grupo", "grupo_desc"), "grupo"
    )


def _un_agente(agentes_g: DataFrame) -> DataFrame:
    """One row per log_name, as the reference's ``GROUP BY llamadas.log_name`` shows one
    agent per name even when the agents table repeats it (picked deterministically)."""
    return (
        agentes_g.groupBy("log_name")
        .agg(F.min(F.struct("grupo", "nombre", "grupo_desc")).alias("_a"))
        .select("log_name", "_a.*")
    )


def _detalle_agentes(
    per_agent: DataFrame, agentes: DataFrame, grupos: DataFrame, programas: DataFrame
) -> DataFrame:
    """Per-agent days joined to agents, groups and programmes (inner, as J1-J3), with the amount.

    The dimensions are reduced to one row per key first, so a repeated key never
    duplicates a report row; the joins run on agent-level rows, after the calls
    have been aggregated.
    """
    ag = _un_agente(_agentes_con_grupo(agentes, grupos))
    d = per_agent.join(ag, "log_name")
    d = d.join(_programas_tarifa(programas), "programa_id")
    return d.select("*", (F.col("n_dias") * F.col("tarifa")).cast(MONEY).alias("importe"))


def _fila(df: DataFrame, cols: list[str], fila: str, tipos: DataFrame) -> DataFrame:
    """One select: ``fila`` marker, and typed NULLs for the columns ``df`` lacks."""
    sel = []
    for c in cols:
        if c == "fila":
            sel.append(F.lit(fila).alias("fila"))
        elif c in df.columns:
            sel.append(F.col(c))
        else:
            sel.append(F.lit(None).cast(tipos.schema[c].dataType).alias(c))
    return df.select(*sel)


def _uno(c: str):
    """The column's value when all rows agree, else NULL."""
    return F.when(F.min(c) == F.max(c), F.min(c))


def _total_global(detalle: DataFrame) -> DataFrame:
    """One total row for the whole result (A8): a global aggregate, so it exists
    even when there are no rows (D10). Programme, month and rate are shown only
    when the result holds a single one (the rate only for a single programme, D14)."""
    un_programa = F.min("programa_id") == F.max("programa_id")
    return detalle.agg(
        *[_uno(c).alias(c) for c in SLICE],
        F.when(un_programa, F.min("nombre_monitor")).alias("nombre_monitor"),
        F.when(un_programa, F.min("tarifa")).alias("tarifa"),
        F.sum("n_dias").cast("bigint").alias("n_dias"),
        F.sum("importe").cast(MONEY).alias("importe"),
    )


def _totales(
    detalle: DataFrame,
    programa: object | None,
    period: Period | None,
    total: str = "tramo",
) -> DataFrame:
    """One total row per slice: sum of the per-agent days and amounts.

    When one programme and one month are asked for, that slice gets its total row
    even with no calls, with NULL sums (D10). ``total="global"``: one row for
    the whole result instead.
    """
    if total == "global":
        return _total_global(detalle)
    if total != "tramo":
        raise ValueError("total must be 'tramo' (one per programme-month) or 'global'")
    # nombre_monitor and tarifa depend on programa_id alone: as grouping keys they
    # keep the aggregate hash-based (a max over text would force a sort-based one).
    tot = detalle.groupBy(*SLICE, "nombre_monitor", "tarifa").agg(
        F.sum("n_dias").cast("bigint").alias("n_dias"),
        F.sum("importe").cast(MONEY).alias("importe"),
    )
    if programa is not None and period is not None:
        spark = detalle.sparkSession
        spine = spark.range(1).select(
            F.lit(programa).cast(detalle.schema["programa_id"].dataType).alias("programa_id"),
            F.lit(period.year).alias("anio"),
            F.lit(period.month).alias("mes"),
        )
        tot = spine.join(tot, SLICE, "left")
    return tot


def dias_con_total(
    calls: DataFrame,
    agentes: DataFrame,
    grupos: DataFrame,
    programas: DataFrame,
    period: Period | None = None,
    programa: object | None = None,
    reglas: DataFrame | None = None,
    excluir_marcadores: bool = False,
    ordenar: bool = False,
    colacion: str | None = None,
    total: str = "tramo",
) -> DataFrame:
    """R2: days and amount per agent, plus one total row per slice.

    Columns: programa_id, anio, mes, fila ('D' detail, 'T' total), grupo,
    log_name, nombre, nombre_monitor, tarifa, n_dias, importe.
    ``importe = n_dias * tarifa`` (D13). Detail and total are joined with UNION
    ALL (D9); the total is derived from the detail frame, so the shared subplan
    is reused rather than recomputed.
    """
    per_agent = dias_por_agente(calls, period, programa, reglas, excluir_marcadores, colacion)
    return _r2(per_agent, con_colacion(agentes, colacion), grupos, programas, period, programa, ordenar, total)


def _r2(per_agent, agentes, grupos, programas, period, programa, ordenar, total="tramo") -> DataFrame:
    det = _detalle_agentes(per_agent, agentes, grupos, programas)
    cols = ["programa_id", "anio", "mes", "fila", "grupo", "log_name", "nombre", "nombre_monitor", "tarifa", "n_dias", "importe"]
    detail = _fila(det, cols, "D", det)
    tot = _fila(_totales(det, programa, period, total), cols, "T", det)
    out = detail.unionByName(tot)
    if ordenar:
        out = out.orderBy(*SLICE, "fila", "grupo", "log_name")
    return out


def dias_por_grupo(
    calls: DataFrame,
    agentes: DataFrame,
    grupos: DataFrame,
    programas: DataFrame,
    period: Period | None = None,
    programa: object | None = None,
    reglas: DataFrame | None = None,
    excluir_marcadores: bool = False,
    ordenar: bool = False,
    colacion: str | None = None,
    total: str = "tramo",
) -> DataFrame:
    """Agent-days and amount per group, plus the per-slice total (A4).

    Agent-days of a group = distinct (log_name, fecha) of its agents, computed as
    the sum of per-agent distinct days over the group's distinct members, so no
    second distinct count runs. The total is the R2 total, as in the reference.
    Columns: programa_id, anio, mes, fila, grupo, grupo_desc, nombre_monitor,
    tarifa, n_dias, importe.
    """
    per_agent = dias_por_agente(calls, period, programa, reglas, excluir_marcadores, colacion)
    return _r3(per_agent, con_colacion(agentes, colacion), grupos, programas, period, programa, ordenar, total)


def _r3(per_agent, agentes, grupos, programas, period, programa, ordenar, total="tramo") -> DataFrame:
    det = _detalle_agentes(per_agent, agentes, grupos, programas)
    # Group membership: an agent listed under two groups counts in both, as the
    # reference's per-group distinct count does; each (agent, group) once.
    miembros = (
        _agentes_con_grupo(agentes, grupos)
        .groupBy("log_name", "grupo")
        .agg(F.min("grupo_desc").alias("grupo_desc"))
    )
    por_grupo = (
        per_agent.join(miembros, "log_name")
        .join(_programas_tarifa(programas), "programa_id")
        .groupBy(*SLICE, "grupo", "grupo_desc", "nombre_monitor", "tarifa")
        .agg(F.sum("n_dias").cast("bigint").alias("n_dias"))
    )
    por_grupo = por_grupo.select("*", (F.col("n_dias") * F.col("tarifa")).cast(MONEY).alias("importe"))
    cols = ["programa_id", "anio", "mes", "fila", "grupo", "grupo_desc", "nombre_monitor", "tarifa", "n_dias", "importe"]
    detail = _fila(por_grupo, cols, "D", det)
    tot = _fila(_totales(det, programa, period, total), cols, "T", det)
    out = detail.unionByName(tot)
    if ordenar:
        out = out.orderBy(*SLICE, "fila", "grupo")
    return out


def informes_dias(
    calls: DataFrame,
    agentes: DataFrame,
    grupos: DataFrame,
    programas: DataFrame,
    period: Period | None = None,
    programa: object | None = None,
    reglas: DataFrame | None = None,
    excluir_marcadores: bool = False,
    ordenar: bool = False,
    colacion: str | None = None,
    materializar: bool = True,
    total: str = "tramo",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three day reports together (R1, R2, R3), from one reading of the calls.

    The per-agent days (agent-level rows, small next to the calls) are
    checkpointed once into the shared ``spark.checkpoint.dir``; all three
    reports are derived from that copy, so writing them reads the calls once.
    """
    per_agent = dias_por_agente(calls, period, programa, reglas, excluir_marcadores, colacion)
    if materializar:
        ensure_checkpoint_dir(per_agent.sparkSession)
        per_agent = per_agent.checkpoint(eager=True)
    ag = con_colacion(agentes, colacion)
    r1 = per_agent.orderBy(*SLICE, "log_name") if ordenar else per_agent
    return (
        r1,
        _r2(per_agent, ag, grupos, programas, period, programa, ordenar, total),
        _r3(per_agent, ag, grupos, programas, period, programa, ordenar, total),
    )


def media_por_agente(
    calls: DataFrame,
    period: Period | None = None,
    programa: object | None = None,
    mensual: bool = False,
    excluir_marcadores: bool = False,
    ordenar: bool = False,
    colacion: str | None = None,
    por_programa: bool = True,
) -> DataFrame:
    """Mean handling time per agent.

    Without ``period`` it covers the whole series (P4). Keys are
    (programa_id, log_name), plus (anio, mes) when ``mensual``; without
    programa_id when ``por_programa=False`` (all programmes together).
    Columns: keys, dur_media ('HH:MM:SS'), media_seg, tot_sec, num_llamadas.
    ``media_seg = tot_sec div count(dur)``, truncated toward zero (A6, D23);
    ``num_llamadas`` counts every call row (A7).
    """
    df = con_colacion(de_programa(en_periodo(calls, period), programa), colacion)
    if excluir_marcadores:
        df = df.where(~((F.col("dur") == 0) & (F.col("llamante") == PLACEHOLDER_CALLER)))
    keys = ["programa_id"] if por_programa else []
    if mensual:
        keys += [F.year("fecha").alias("anio"), F.month("fecha").alias("mes")]
    keys.append("log_name")
    agg = df.groupBy(*keys).agg(
        F.sum("dur").cast("bigint").alias("tot_sec"),
        F.count("dur").alias("_n_dur"),
        F.count(F.lit(1)).alias("num_llamadas"),
    )
    media = F.when(F.col("_n_dur") > 0, F.expr("tot_sec div _n_dur"))
    key_names = (["programa_id"] if por_programa else []) + (["anio", "mes"] if mensual else []) + ["log_name"]
    out = agg.select(
        *key_names,
        seg_a_hora(media).alias("dur_media"),
        media.alias("media_seg"),
        "tot_sec",
        "num_llamadas",
    )
    if ordenar:
        out = out.orderBy("media_seg", "log_name")
    return out
