"""Two forms of one operator, timed in turns in one session: ``python tools/time_forms.py SF_DIR [runs]``.

* days per agent: a set of day bits per month, against a distinct over the days and a count;
* insert-ignore: first row per key before the anti-join, against the anti-join first.
Prints the median seconds of each and the exchanges in its plan.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from workdays.model import DEFAULT_KEY  # noqa: E402
from workdays.operators import load  # noqa: E402
from workdays.plans import reports  # noqa: E402
from workdays.session import local_session  # noqa: E402
from workdays.sources import tables as t  # noqa: E402


def por_distintos(calls):
    dias = reports.dias_agente(calls)
    return dias.groupBy("programa_id", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"), "log_name").agg(F.count("fecha").alias("n_dias"))


def formas(spark, d):
    calls = t.llamadas(spark, d)
    tabla, lote = calls.where("fecha < DATE'1998-01-01'"), calls.where("fecha >= DATE'1997-06-01'")
    clave = list(DEFAULT_KEY)

    def antes(tabla, lote):
        quedan = lote.join(tabla.select(*clave), clave, "left_anti")
        return load.primero_por_clave(quedan, clave)

    return {
        "dias: bits": lambda: reports.dias_por_agente(calls),
        "dias: distinct": lambda: por_distintos(calls),
        "insert-ignore: first, then anti-join": lambda: load.insertar_ignorando(tabla, lote, clave),
        "insert-ignore: anti-join, then first": lambda: antes(tabla, lote),
    }


def main() -> None:
    d, veces = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 5
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    tiempos: dict[str, list[float]] = {}
    todas = formas(spark, d)
    for vez in range(veces + 1):
        for nombre, forma in todas.items():
            inicio = time.time()
            forma().write.format("noop").mode("overwrite").save()
            if vez:  # the first turn warms up
                tiempos.setdefault(nombre, []).append(time.time() - inicio)
    for nombre, forma in todas.items():
        plan = forma()._jdf.queryExecution().executedPlan().toString()
        print(f"{nombre}: {statistics.median(tiempos[nombre]):.2f} s, {plan.count('Exchange hashpartitioning')} hash exchanges")


if __name__ == "__main__":
    main()
