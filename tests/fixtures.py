"""Hand-made rows for what the generated tables cannot show (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal

from workdays.model import AGENTS, CALLS, GROUPS, PROGRAMMES, RULES

D = dt.date


def llamada(fecha, log_name, programa_id, dur=30, hora="10:00:00", llamante="600000000"):
    return (fecha, hora, llamante, dur, None, None, log_name, "r", programa_id)


def calls(spark, rows):
    return spark.createDataFrame(rows, CALLS)


def dims(spark):
    agentes = spark.createDataFrame(
        [
            ("ana", "Ana", 1, 1),
            ("bob", "Bob", 1, 1),
            ("cid", "Cid", 2, 0),
            ("dan", "Dan", 3, 1),  # equal description and figures to group 2
            ("eve", "Eve", 99, 1),  # group missing from grupos
            ("Ana ", "Ana2", 1, 1),  # differs from 'ana' only in case and a trailing space
        ],
        AGENTS,
    )
    grupos = spark.createDataFrame([(1, "Mañana"), (2, "Noche"), (3, "Noche")], GROUPS)
    programas = spark.createDataFrame(
        [
            (17, "Anillos", "ANILLOS", None, None, 1, "23:00:00", Decimal("10.50")),
            (18, "Relojes", "RELOJ", "REL", "rel", 1, "21:30:00", Decimal("20.00")),
            (19, "Viejo", "OLD", "OLD", None, 0, "20:00:00", Decimal("5.00")),
        ],
        PROGRAMMES,
    )
    return agentes, grupos, programas


def reglas(spark, rows):
    return spark.createDataFrame(rows, RULES)
