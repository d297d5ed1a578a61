import datetime as dt

import pytest
from pyspark.sql import functions as F

from workdays.functions import normalize as N
from workdays.functions import present as P


def _one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("19/8/2017 0:00:00", dt.date(2017, 8, 19)),  # docstring example
        ("2017-08-19", dt.date(2017, 8, 19)),  # docstring example
        ("19/8/2017", dt.date(2017, 8, 19)),
        ("2017/08/19", dt.date(2017, 8, 19)),
        ("19-8-2017", dt.date(2017, 8, 19)),
        ("1/8/2017", dt.date(2017, 8, 1)),
        (" 2017-8-1 ", dt.date(2017, 8, 1)),
        ("31/2/2017", None),
        ("2017/13/01", None),
        ("19/8/17", None),
        ("", None),
        (None, None),
    ],
)
def test_fecha(spark, text, expected):
    assert _one(spark, N.fecha, text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("30/12/1899 7:54:15", "07:54:15"),  # docstring example
        ("7:54:15", "07:54:15"),
        ("07:54:15", "07:54:15"),
        ("7:5:3", "07:05:03"),
        ("99:99:99", None),
        ("24:00:00", None),
        ("12:00", None),
        ("", None),
        (None, None),
    ],
)
def test_hora(spark, text, expected):
    assert _one(spark, N.hora, text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("56,00", 56), ("56", 56), ("", None), ("56.5", None), ("-5,9", -5), (None, None), ("abc", None)],
)
def test_duracion(spark, text, expected):
    assert _one(spark, N.duracion, text) == expected


@pytest.mark.parametrize(
    "d,days",
    [(dt.date(2024, 2, 10), 29), (dt.date(2023, 2, 1), 28), (dt.date(2023, 12, 31), 31), (dt.date(2023, 4, 5), 30)],
)
def test_dias_del_mes(spark, d, days):
    assert _one(spark, N.dias_del_mes, d, "date") == days


@pytest.mark.parametrize(
    "n,text",
    [(0, "00:00:00"), (59, "00:00:59"), (3600, "01:00:00"), (90000, "25:00:00"), (-5, "-00:00:05"), (10**8, "838:59:59"), (None, None)],
)
def test_seg_a_hora(spark, n, text):
    assert _one(spark, P.seg_a_hora, n, "long") == text


@pytest.mark.parametrize(
    "x,text",
    [(0.125, "0,13"), (1234567.891, "1.234.567,89"), (0.0, "0,00"), (-1234.5, "-1.234,50")],
)
def test_dinero_es(spark, x, text):
    assert _one(spark, P.dinero_es, x, "double") == text


def test_dinero_sin_miles(spark):
    df = spark.createDataFrame([(1234567.891,)], "x double")
    assert df.select(P.dinero_es("x", "").alias("y")).first()["y"] == "1234567,89"


def test_normalizar_motivo(spark):
    raw = spark.createDataFrame(
        [("19/8/2017", "7:54:15", "56,00"), ("31/2/2017", "99:99:99", "56.5"), ("2017-08-19", "x", "3")],
        "fecha_txt string, hora_txt string, dur_txt string",
    )
    good, bad = N.separar(N.normalizar(raw))
    assert good.count() == 1
    motivos = sorted(r["motivo"] for r in bad.collect())
    assert motivos == ["fecha,hora,dur", "hora"]


def test_small_helpers(spark):
    df = spark.createDataFrame([(dt.date(2017, 8, 9), None, "M")], "d date, n string, m string")
    r = df.select(
        N.clave_dia("d").alias("a"),
        N.clave_dia_compacta("d").alias("b"),
        N.dos_cifras(F.month("d")).alias("c"),
        N.vacio_si_nulo("n").alias("e"),
        N.etiqueta("m", "d").alias("f"),
    ).first()
    assert tuple(r) == ("2017-08-09", "20170809", "08", "", "M - 2017-08-09")
