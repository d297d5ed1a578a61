"""Normalising the text fields of call exports (F7-F14), as column expressions.

Nothing here is a Python UDF: every function returns a Catalyst expression that
runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import PROMPT_YEAR_MAX, PROMPT_YEAR_MIN

# The date layouts accepted for the call day, tried in this order.
DATE_PATTERNS = ("d/M/yyyy", "yyyy/M/d", "d-M-yyyy", "yyyy-M-d")

_TIME_RE = r"^([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})$"
_INT_RE = r"^[+-]?[0-9]+$"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fecha(x: str | Column) -> Column:
    """call day text -> DATE, NULL when it cannot be read.

    Accepts ``19/8/2017``, ``19/8/2017 0:00:00``, ``2017-08-19``, ``2017/08/19``,
    ``19-8-2017``. A time after the first space is ignored. Impossible days
    (``31/2/2017``) and two-digit years give NULL.
    """
    day = F.split(F.trim(_c(x)), " ").getItem(0)
    return F.coalesce(*[F.try_to_date(day, p) for p in DATE_PATTERNS])


def hora(x: str | Column) -> Column:
    """F8: call time text -> ``HH:MM:SS``, NULL when it is not a time of day.

    Accepts ``07:54:15``, ``7:54:15``, ``7:5:3`` and ``30/12/1899 7:54:15``
    (the part after the last space).
    """
    t = F.element_at(F.split(F.trim(_c(x)), " "), -1)
    # one pattern check, then the parts by a plain split on ':'
    p = F.split(t, ":")
    h, m, s = (F.element_at(p, i) for i in (1, 2, 3))
    ok = t.rlike(_TIME_RE) & (h.cast("int") < 24) & (m.cast("int") < 60) & (s.cast("int") < 60)
    return F.when(ok, F.concat_ws(":", F.lpad(h, 2, "0"), F.lpad(m, 2, "0"), F.lpad(s, 2, "0")))


def duracion(x: str | Column) -> Column:
    """whole seconds before the decimal comma, ``56,00`` -> 56, ``-5,9`` -> -5.

    Text that is not an integer before the comma (``''``, ``56.5``) gives NULL.
    """
    head = F.trim(F.split(_c(x), ",").getItem(0))
    return F.when(head.rlike(_INT_RE), head.try_cast("int"))


def dias_del_mes(d: str | Column) -> Column:
    """number of days in the month of a date."""
    return F.dayofmonth(F.last_day(_c(d)))


def clave_dia(d: str | Column) -> Column:
    """``YYYY-MM-DD`` text."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def clave_dia_compacta(d: str | Column) -> Column:
    """``YYYYMMDD`` text (the day key in export file names)."""
    return F.date_format(_c(d), "yyyyMMdd")


def dos_cifras(x: str | Column) -> Column:
    """integer as at least two digits, ``7`` -> ``07``."""
    return F.format_string("%02d", _c(x).cast("int"))


def vacio_si_nulo(x: str | Column) -> Column:
    """NULL -> ''."""
    return F.coalesce(_c(x), F.lit(""))


def etiqueta(monitor: str | Column, d: str | Column) -> Column:
    """show label ``'<monitor> - <YYYY-MM-DD>'`` searched for in the export list."""
    return F.concat_ws(" - ", _c(monitor), clave_dia(d))


def normalizar(raw: DataFrame) -> DataFrame:
    """Parse the text columns of a raw export into the calls schema, keeping the reason of any failure.

    ``raw`` carries text columns ``fecha_txt hora_txt llamante dur_txt station
    voice_file log_name resultado`` (plus anything else, kept as is). Adds
    ``fecha`` DATE, ``hora`` text, ``dur`` INT and ``motivo``: NULL for a good
    row, otherwise the failed fields separated by commas.
    """
    parsed = raw.withColumn("fecha", fecha("fecha_txt")).withColumn("hora", hora("hora_txt")).withColumn(
        "dur", duracion("dur_txt")
    )
    motivo = F.concat_ws(
        ",",
        F.when(F.col("fecha").isNull(), F.lit("fecha")),
        F.when(F.col("hora").isNull(), F.lit("hora")),
        F.when(F.col("dur").isNull(), F.lit("dur")),
    )
    return parsed.withColumn("motivo", F.when(motivo != "", motivo))


def separar(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a ``normalizar`` result into (good rows, quarantined rows)."""
    return parsed.where(F.col("motivo").isNull()).drop("motivo"), parsed.where(F.col("motivo").isNotNull())


def periodo_valido(anio: Column | str, mes: Column | str) -> Column:
    """P12 for columns: month 1-12 of a year that the prompt takes; NULL is not valid."""
    a, m = F.col(anio) if isinstance(anio, str) else anio, F.col(mes) if isinstance(mes, str) else mes
    return F.coalesce(m.between(1, 12) & a.between(PROMPT_YEAR_MIN, PROMPT_YEAR_MAX), F.lit(False))


def rango_valido(anio: Column | str, mes: Column | str, ini: Column, fin: Column) -> Column:
    """P13 for columns: 1 <= ini <= fin <= days of the month; NULL, or a month that is none, is not valid."""
    a, m = F.col(anio) if isinstance(anio, str) else anio, F.col(mes) if isinstance(mes, str) else mes
    primero = F.when(m.between(1, 12), F.make_date(a, m, F.lit(1)))
    return F.coalesce((ini >= 1) & (ini <= fin) & (fin <= F.day(F.last_day(primero))), F.lit(False))
