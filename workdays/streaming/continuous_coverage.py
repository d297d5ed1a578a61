"""Coverage (X1) as a stream: a day without calls is reported when the watermark has passed it.

Each programme has event-time state: the first day not yet decided, the last day of its
last month with calls, and the days seen from there on. A timer at the first undecided day wakes
the programme when the watermark passes that day; a day that was not seen is then emitted once.
As in the batch form a programme is expected from the first to the last month it has calls
in, so a month without calls is reported as soon as a later one has some. The calls are reduced to
distinct (programme, day) before they reach the state, so a programme's state takes days, not calls.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

ESTADO = "desde int, fin int, vistos array<int>"
_UNO = dt.date(1970, 1, 1)
_DIA_MS = 86_400_000


def _mes(dia: int) -> tuple[int, int]:
    """First and last day of the month of a day, all as days since 1970."""
    d = _UNO + dt.timedelta(days=dia)
    primero = d.replace(day=1)
    ultimo = (primero + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1)
    return (primero - _UNO).days, (ultimo - _UNO).days


def decidir(desde: int, fin: int, vistos: set[int], marca_ms: int) -> tuple[list[int], int]:
    """(days to report, first undecided day): days up to ``fin`` that the watermark has passed."""
    faltan = []
    while desde <= fin and desde * _DIA_MS < marca_ms:
        if desde not in vistos:
            faltan.append(desde)
        desde += 1
    return faltan, desde


def _programa(clave: tuple, partes: Iterator[pd.DataFrame], estado: GroupState) -> Iterator[pd.DataFrame]:
    desde, fin, antes = estado.get if estado.exists else (None, None, [])
    vistos = set(antes)
    if not estado.hasTimedOut:
        for parte in partes:
            for dia in parte["dia"].tolist():
                primero, ultimo = _mes(int(dia))
                # a day before the first undecided one comes only while no day is decided: what is
                # behind the watermark is dropped
                desde = primero if desde is None or dia < desde else desde
                fin = ultimo if fin is None else max(fin, ultimo)
                vistos.add(int(dia))
    if desde is None:
        return
    marca = estado.getCurrentWatermarkMs()
    faltan, desde = decidir(desde, fin, vistos, marca)
    estado.update((desde, fin, sorted(d for d in vistos if d >= desde)))
    estado.setTimeoutTimestamp(max(desde * _DIA_MS + 1, marca + 1))
    if faltan:
        fechas = [_UNO + dt.timedelta(days=d) for d in faltan]
        yield pd.DataFrame({"programa_id": [clave[0]] * len(fechas), "fecha": fechas})


def cobertura_continua(calls: DataFrame, retraso: str = "2 days") -> DataFrame:
    """(programa_id, fecha) of the days without calls of a stream ``calls`` (programa_id, fecha).

    A call may come up to ``retraso`` after later days have; a day is reported once, when the
    watermark passes it, and a call behind the watermark is dropped. The rows reported so far are
    those of ``coverage.cobertura`` of the calls, up to the watermark. Calls without a day or
    a programme are ignored.
    """
    dias = calls.select("programa_id", F.col("fecha").cast("timestamp").alias("_t"))
    dias = dias.where(F.col("programa_id").isNotNull() & F.col("_t").isNotNull())
    dias = dias.withWatermark("_t", retraso).dropDuplicates(["programa_id", "_t"])
    dias = dias.select("programa_id", "_t", F.unix_date(F.to_date("_t")).alias("dia"))
    tipo = calls.schema["programa_id"].dataType.simpleString()
    return dias.groupBy("programa_id").applyInPandasWithState(
        _programa, f"programa_id {tipo}, fecha date", ESTADO, "append", GroupStateTimeout.EventTimeTimeout
    )
