"""Schemas, the reporting period and default keys."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values that must match the reference behaviour.
# Years accepted by the interactive period prompt: 2017 to 2049 inclusive.
PROMPT_YEAR_MIN = 2017
PROMPT_YEAR_MAX = 2049
# Attendance placeholder row: caller number and call result text.
PLACEHOLDER_CALLER = "34000000000"
PLACEHOLDER_RESULT = "Request for information without order"
# Load-file header names read by name (the first column is read by position).
HEADER_CALL_TIME = "Call time"
HEADER_CALLER = "Caller"
HEADER_LENGTH = "Length"
HEADER_STATION = "Station"
HEADER_VOICE_FILE = "Voice file"
HEADER_LOGIN = "Login name"
HEADER_RESULT = "Call result"
HEADER_OPTIONAL_DROP = "CC"
# File names: daily export "YYYYMMDD [SALIDA ]multioption_monitor_<time>.<ext>",
# monthly load file "YYYYMM [SALIDA ]to_access.csv".
EXPORT_NAME_STEM = "multioption_monitor_"
LOAD_NAME_END = "to_access.csv"

CALLS = T.StructType(
    [
        T.StructField("fecha", T.DateType()),
        T.StructField("hora", T.StringType()),
        T.StructField("llamante", T.StringType()),
        T.StructField("dur", T.IntegerType()),
        T.StructField("station", T.StringType()),
        T.StructField("voice_file", T.StringType()),
        T.StructField("log_name", T.StringType()),
        T.StructField("resultado", T.StringType()),
        T.StructField("programa_id", T.IntegerType()),
    ]
)

PROGRAMMES = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("nombre_excel", T.StringType()),
        T.StructField("nombre_monitor", T.StringType()),
        T.StructField("nombre_salida", T.StringType()),
        T.StructField("directorio", T.StringType()),
        T.StructField("activo", T.IntegerType()),
        T.StructField("hora_fin", T.StringType()),
        T.StructField("factura_hora", T.DecimalType(10, 2)),
    ]
)

AGENTS = T.StructType(
    [
        T.StructField("log_name", T.StringType()),
        T.StructField("nombre", T.StringType()),
        T.StructField("grupo", T.IntegerType()),
        T.StructField("activo", T.IntegerType()),
    ]
)

GROUPS = T.StructType(
    [
        T.StructField("grupo", T.IntegerType()),
        T.StructField("grupo_desc", T.StringType()),
    ]
)

# Exclusion rules: drop an agent from one programme-month (anio_mes is "YYYY-MM").
RULES = T.StructType(
    [
        T.StructField("programa_id", T.IntegerType()),
        T.StructField("anio_mes", T.StringType()),
        T.StructField("log_name", T.StringType()),
    ]
)

# Unique key of the calls table used by the insert-ignore load.
DEFAULT_KEY = ("fecha", "hora", "llamante", "log_name", "programa_id")

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(10, 2)


@dataclass(frozen=True)
class Period:
    """A calendar month. ``Period(2022, 11)`` covers 2022-11-01 .. 2022-11-30."""

    year: int
    month: int

    def __post_init__(self) -> None:
        if not isinstance(self.year, int) or not isinstance(self.month, int):
            raise TypeError("year and month must be int")
        if not 1 <= self.month <= 12:
            raise ValueError(f"month must be 1-12, got {self.month}")
        if not 1 <= self.year <= 9999:
            raise ValueError(f"year out of range: {self.year}")

    @classmethod
    def parse(cls, text: str) -> "Period":
        """``'2022-11'`` or ``'202211'``."""
        s = text.strip().replace("-", "").replace("/", "")
        if len(s) != 6 or not s.isdigit():
            raise ValueError(f"period must look like YYYY-MM: {text!r}")
        return cls(int(s[:4]), int(s[4:]))

    @property
    def first(self) -> dt.date:
        return dt.date(self.year, self.month, 1)

    @property
    def days(self) -> int:
        return calendar.monthrange(self.year, self.month)[1]

    @property
    def last(self) -> dt.date:
        return dt.date(self.year, self.month, self.days)

    @property
    def next_first(self) -> dt.date:
        return self.last + dt.timedelta(days=1)

    @property
    def key(self) -> str:
        return f"{self.year:04d}-{self.month:02d}"

    def day_range(self, ini: int | None = None, fin: int | None = None) -> tuple[dt.date, dt.date]:
        """Validated day window inside the month: 1 <= ini <= fin <= days."""
        ini = 1 if ini is None else int(ini)
        fin = self.days if fin is None else int(fin)
        if ini < 1:
            raise ValueError("first day cannot be below 1")
        if ini > self.days:
            raise ValueError(f"first day cannot exceed {self.days}")
        if fin > self.days:
            raise ValueError(f"last day cannot exceed {self.days}")
        if fin < 1 or fin < ini:
            raise ValueError("last day must be >= 1 and >= first day")
        return dt.date(self.year, self.month, ini), dt.date(self.year, self.month, fin)


def prompt_period(year: int | str, month: int | str) -> Period:
    """Period as accepted by the interactive prompt (years 2017-2049)."""
    y, m = int(year), int(month)
    if not 1 <= m <= 12:
        raise ValueError(f"month must be 1-12, got {m}")
    if not PROMPT_YEAR_MIN <= y <= PROMPT_YEAR_MAX:
        raise ValueError(f"year must be {PROMPT_YEAR_MIN}-{PROMPT_YEAR_MAX}, got {y}")
    return Period(y, m)
