"""Random header layouts against a plain-Python reading by name (first column by position)."""

import csv
import io
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from workdays.sources import files

NAMED = ["Call time", "Caller", "Length", "Station", "Voice file", "Login name", "Call result"]
COLS = {"Call time": "hora_txt", "Caller": "llamante", "Length": "dur_txt", "Station": "station",
        "Voice file": "voice_file", "Login name": "log_name", "Call result": "resultado"}
value = st.text(alphabet="abcXYZ019 ,/:-ñ;\"\\", min_size=0, max_size=6)


@st.composite
def archivo(draw):
    # "Call time" is always present (it marks the header); the others may be missing or moved
    others = draw(st.permutations([c for c in NAMED if c != "Call time"]))
    keep = draw(st.lists(st.booleans(), min_size=len(others), max_size=len(others)))
    cols = ["Call time"] + [c for c, k in zip(others, keep) if k]
    cols = draw(st.permutations(cols))
    if draw(st.booleans()):
        pos = draw(st.integers(0, len(cols)))
        cols = cols[:pos] + ["CC"] + cols[pos:]
    cols = [draw(st.sampled_from(["Call day", "ÿDay", "x"]))] + cols
    if "CC" not in cols and draw(st.booleans()):
        cols = ["CC"] + cols
    rows = draw(st.lists(st.lists(value, min_size=len(cols), max_size=len(cols)), min_size=1, max_size=4))
    return cols, rows


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(archivo(), min_size=1, max_size=3))
def test_alignment_matches_reading_by_name(spark, archivos):
    d = tempfile.mkdtemp(prefix="run-reader-", dir="/tmp")
    want = []
    for k, (header, rows) in enumerate(archivos):
        name = f"2017{k + 1:02d} to_access.csv"
        buf = io.StringIO()
        w = csv.writer(buf, delimiter=";", lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
        w.writerow(header)
        w.writerows(rows)
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(buf.getvalue())
        for rec in csv.DictReader(io.StringIO(buf.getvalue()), delimiter=";"):
            dia = header[1] if header[0] == "CC" else header[0]
            got = {"fecha_txt": rec[dia], "archivo": name}
            for h, c in COLS.items():
                got[c] = rec.get(h)
            want.append(got)
    df = files.leer_delimitado(spark, f"{d}/*to_access.csv")
    have = [{k: r[k] for k in ["fecha_txt", "archivo", *COLS.values()]} for r in df.collect()]
    key = lambda x: sorted((k, str(v)) for k, v in x.items())
    assert sorted(map(key, have)) == sorted(map(key, want))
