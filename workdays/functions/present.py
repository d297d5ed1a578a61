"""Display-only expressions (F2-F4) and a portable output encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: largest magnitude of a SQL TIME, 838:59:59, in seconds.
TIME_MAX_SECONDS = 838 * 3600 + 59 * 60 + 59


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dinero_es(x: str | Column, miles: str = ".") -> Column:
    """F2: money as Spanish text, ``1234567.891`` -> ``1.234.567,89``.

    Rounded half-up first: ``format_number`` alone rounds half-even.
    ``miles`` is the thousands separator, one character or '' for none.
    """
    if len(miles) > 1:
        raise ValueError("thousands separator must be one character or empty")
    s = F.format_number(F.round(_c(x), 2), 2)  # 1,234,567.89
    if miles:
        return F.translate(s, ",.", miles + ",")
    return F.translate(F.regexp_replace(s, ",", ""), ".", ",")


def texto(x: str | Column) -> Column:
    """``CAST(x AS CHAR)``."""
    return _c(x).cast("string")


def seg_a_hora(x: str | Column) -> Column:
    """seconds as ``[-]HH:MM:SS``; hours past 24 keep counting, clamped at 838:59:59."""
    n = _c(x).cast("long")
    a = F.least(F.abs(n), F.lit(TIME_MAX_SECONDS))
    txt = F.format_string(
        "%s%02d:%02d:%02d",
        F.when(n < 0, F.lit("-")).otherwise(F.lit("")),
        (a / 3600).cast("long"),
        ((a / 60).cast("long") % 60),
        a % 60,
    )
    return F.when(n.isNull(), F.lit(None).cast("string")).otherwise(txt)


def portable(df: DataFrame) -> DataFrame:
    """Encode decimals as double, dates as ``yyyy-MM-dd`` and timestamps as ``yyyy-MM-dd HH:mm:ss`` text.

    Client libraries map DECIMAL and DATE differently (Decimal objects against
    floats, ``date`` against timestamps); this encoding compares equal across them.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# Markers printed in the total row of the billing reports.
MARCA_VACIO = "-----"
MARCA_TOTAL = "-TOTAL:-->"
# Display titles of the report columns (the title row of the
# per-agent report: Año, Mes, Nombre, Agente, Programa, €/día, Núm. Días, Total €;
# of the per-group report: Año, Mes, Grupo, Programa, €/día, Total d., Total €).
TITULOS_AGENTE = {
    "anio": "Año",
    "mes": "Mes",
    "nombre": "Nombre",
    "log_name": "Agente",
    "nombre_monitor": "Programa",
    "tarifa": "€/día",
    "n_dias": "Núm. Días",
    "importe": "Total €",
}
TITULOS_GRUPO = {
    "anio": "Año",
    "mes": "Mes",
    "grupo_desc": "Grupo",
    "nombre_monitor": "Programa",
    "tarifa": "€/día",
    "n_dias": "Total d.",
    "importe": "Total €",
}


def presentar(informe: DataFrame, miles: str = ".", titulos: bool = False) -> DataFrame:
    """Display form of a ``dias_con_total`` / ``dias_por_grupo`` result.

    Money (``tarifa``, ``importe``) becomes Spanish text (F2), the day count text
    (F3); in total rows the name columns show ``-----`` and the programme column
    ``-TOTAL:-->``. The slice columns (programa_id, anio, mes) and ``fila`` stay,
    since one result holds many programme-months. With ``titulos`` the columns
    take the display titles (U1: the title row becomes the column names) in
    display order, after programa_id and fila.
    """
    total = F.col("fila") == "T"
    out = informe
    for c in ("nombre", "log_name", "grupo_desc"):
        if c in informe.columns:
            out = out.withColumn(c, F.when(total, F.lit(MARCA_VACIO)).otherwise(texto(c)))
    out = out.withColumn(
        "nombre_monitor", F.when(total, F.lit(MARCA_TOTAL)).otherwise(F.col("nombre_monitor"))
    )
    out = (
        out.withColumn("tarifa", dinero_es("tarifa", miles))
        .withColumn("importe", dinero_es("importe", miles))
        .withColumn("n_dias", texto("n_dias"))
    )
    if titulos:
        nombres = TITULOS_AGENTE if "log_name" in informe.columns else TITULOS_GRUPO
        out = out.select("programa_id", "fila", *[F.col(c).alias(t) for c, t in nombres.items()])
    return out
