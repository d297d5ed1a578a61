"""Coverage check (G1, X1): programme-days with no export or call."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.normalize import etiqueta
from ..model import Period
from ..operators.filters import activos, en_periodo


def dias(inicio, fin):
    """G1: one row per day from ``inicio`` to ``fin`` inclusive (column expressions)."""
    return F.explode(F.sequence(inicio, fin, F.expr("INTERVAL 1 DAY")))


def _huecos(got: DataFrame) -> DataFrame:
    """Days without data of each programme, over the whole months from its first to its last day.

    ``got``: distinct (programa_id, fecha). Each day yields the gap before it; the last day also
    the rest of its month.
    """
    por_dia = W.partitionBy("programa_id").orderBy("fecha")
    antes, despues = F.lag("fecha").over(por_dia), F.lead("fecha").over(por_dia)
    g = got.select("programa_id", "fecha", antes.alias("_antes"), despues.alias("_despues"))
    inicio = F.coalesce(F.date_add("_antes", 1), F.trunc("fecha", "month"))
    previo = F.when(inicio < F.col("fecha"), F.sequence(inicio, F.date_sub("fecha", 1)))
    fin = F.last_day("fecha")
    resto = F.when(F.col("_despues").isNull() & (F.col("fecha") < fin), F.sequence(F.date_add("fecha", 1), fin))
    nada = F.array().cast("array<date>")
    huecos = F.concat(F.coalesce(previo, nada), F.coalesce(resto, nada))
    return g.select("programa_id", F.explode(huecos).alias("fecha"))


def cobertura(
    recibidos: DataFrame,
    programas: DataFrame | None = None,
    period: Period | None = None,
    d_ini: int | None = None,
    d_fin: int | None = None,
) -> DataFrame:
    """Expected (programa_id, fecha) minus the days received.

    ``recibidos`` has (programa_id, fecha): days with data. With ``period``,
    every active programme is expected on each day ``d_ini..d_fin`` of that month
    (validated as P13). Without it, each programme is expected on every day of
    the months from its first to its last month with data.
    With a period, the expected days are generated per programme row with ``sequence`` and the
    result is a left anti-join on (programa_id, fecha); without one, the gaps are read off the
    ordered days of each programme (a calendar's length at most), so the calls are read once.
    Columns: programa_id, fecha, plus ``etiqueta`` ('<monitor> - <day>') when
    ``programas`` is given.
    """
    if period is not None:
        if programas is None:
            raise ValueError("a period needs the programmes table")
        d0, d1 = period.day_range(d_ini, d_fin)
        # only the window's days are read (pushed to the scan; prunes month partitions)
        recibidos = en_periodo(recibidos, period).where(F.col("fecha").between(F.lit(d0), F.lit(d1)))
    got = recibidos.select("programa_id", "fecha").where(F.col("fecha").isNotNull()).distinct()
    if period is not None:
        esperado = activos(programas).select(
            F.col("id").alias("programa_id"), dias(F.lit(d0), F.lit(d1)).alias("fecha")
        )
        faltan = esperado.join(got, ["programa_id", "fecha"], "left_anti")
    else:
        faltan = _huecos(got)
    if programas is not None:
        faltan = faltan.join(
            programas.select(F.col("id").alias("programa_id"), "nombre_monitor"), "programa_id", "left"
        ).select("programa_id", "fecha", etiqueta("nombre_monitor", "fecha").alias("etiqueta"))
    return faltan


_FECHA_TRAS_SEP = r" - (?=[0-9]{4}-[0-9]{2}-[0-9]{2})"
_SEP_FECHA = r" - [0-9]{4}-[0-9]{2}-[0-9]{2}"
_PRIMERA = r"(?s)^(.*?) - ([0-9]{4}-[0-9]{2}-[0-9]{2})"


def prefijos_en_textos(opciones: DataFrame, col: str = "texto", desde=None, hasta=None) -> DataFrame:
    """For every date ``' - <YYYY-MM-DD>'`` in a text, the day and the text before it.

    A text contains the label ``'<monitor> - <day>'`` exactly when one of its prefixes of that
    day ends with the monitor's name. Line breaks are ordinary characters.
    ``desde``/``hasta`` (dates) keep only those days. Columns: fecha, pre (distinct).
    """
    texto = F.col(col)
    n = F.regexp_count(texto, F.lit(_SEP_FECHA))
    # One date (the usual listing): a single regex gives the prefix and the day.
    una = F.array(
        F.struct(
            F.regexp_extract(texto, _PRIMERA, 2).alias("d"),
            F.regexp_extract(texto, _PRIMERA, 1).alias("pre"),
        )
    )
    # Several dates: split before each, the k-th prefix is the first k parts rejoined.
    partes = F.split(texto, _FECHA_TRAS_SEP)
    varias = F.transform(
        F.sequence(F.lit(1), F.size(partes) - 1),
        lambda k: F.struct(
            F.substring(F.element_at(partes, k + 1), 1, 10).alias("d"),
            F.array_join(F.slice(partes, 1, k), " - ").alias("pre"),
        ),
    )
    o = (
        opciones.where(n > 0)
        .select(F.explode(F.when(n == 1, una).otherwise(varias)).alias("o"))
        .select(F.try_to_date(F.col("o.d"), "yyyy-MM-dd").alias("fecha"), "o.pre")
        .where(F.col("fecha").isNotNull() & (F.length("pre") > 0))
    )
    if desde is not None:
        o = o.where(F.col("fecha") >= F.lit(desde))
    if hasta is not None:
        o = o.where(F.col("fecha") <= F.lit(hasta))
    # listings repeat the same show text
    return o.distinct()


def cobertura_etiquetas(
    opciones: DataFrame,
    programas: DataFrame,
    period: Period,
    d_ini: int | None = None,
    d_fin: int | None = None,
    col: str = "texto",
) -> DataFrame:
    """X1 with P14: active programme-days of a month whose label no listed text contains.

    ``opciones`` holds the texts of the listed shows (one per row in ``col``). A text's prefix of a
    day ends with a name exactly when its last ``n`` characters are the name, ``n`` being the name's
    length, so each prefix meets the names by (day, suffix) once for each length that names have:
    an equality, whose keys grow with the names.
    Columns: programa_id, fecha, etiqueta.
    """
    d0, d1 = period.day_range(d_ini, d_fin)
    activas = activos(programas)
    esperado = activas.select(
        F.col("id").alias("programa_id"), "nombre_monitor", dias(F.lit(d0), F.lit(d1)).alias("fecha")
    )
    # the distinct lengths of the names: one short array, computed inside the query
    largos = activas.agg(F.collect_set(F.length("nombre_monitor"))).scalar()
    h = prefijos_en_textos(opciones, col, d0, d1).withColumn("_n", F.explode(largos))
    h = h.where(F.col("_n") <= F.length("pre")).select("fecha", F.right("pre", F.col("_n")).alias("nombre_monitor")).distinct()
    faltan = esperado.join(h, ["fecha", "nombre_monitor"], "left_anti")
    return faltan.select("programa_id", "fecha", etiqueta("nombre_monitor", "fecha").alias("etiqueta"))
