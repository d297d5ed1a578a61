"""Coverage as a stream: the rows of all micro-batches are those of the batch form."""

import datetime as dt
import random

import pytest

from workdays.plans import coverage
from workdays.streaming.continuous_coverage import cobertura_continua

FIN = 9999  # a programme whose far day moves the watermark past all others


@pytest.mark.parametrize("seed", [1, 2])
def test_the_stream_reports_what_the_batch_does(spark, tmp_path, seed):
    r = random.Random(seed)
    filas = []
    for p in (1, 2, 3):
        for k in range(r.randint(0, 20), 150):
            if r.random() < 0.5 and not (p == 2 and 40 < k < 110):  # programme 2 has whole months without calls
                filas += [(p, dt.date(2022, 1, 1) + dt.timedelta(days=k))] * r.randint(1, 3)
    filas += [(1, None), (None, dt.date(2022, 2, 2))]
    orden = sorted(filas, key=lambda x: ((x[1] or dt.date(2022, 1, 1)) + dt.timedelta(days=r.randint(0, 2))))  # up to two days late
    esquema = "programa_id int, fecha date"
    origen = f"{tmp_path}/in"
    partes = [orden[k : k + 40] for k in range(0, len(orden), 40)] + [[(FIN, dt.date(2023, 1, 1))], [(FIN, dt.date(2023, 1, 2))]]
    for parte in partes:
        spark.createDataFrame(parte, esquema).coalesce(1).write.mode("append").parquet(origen)
    stream = spark.readStream.schema(esquema).option("maxFilesPerTrigger", 1).parquet(origen)
    q = (
        cobertura_continua(stream).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck")
        .trigger(availableNow=True).start(f"{tmp_path}/out")
    )
    q.awaitTermination()
    got = [(x.programa_id, x.fecha) for x in spark.read.parquet(f"{tmp_path}/out").where(f"programa_id <> {FIN}").collect()]
    llegadas = spark.createDataFrame([f for f in filas if None not in f], esquema)
    want = [(x.programa_id, x.fecha) for x in coverage.cobertura(llegadas).select("programa_id", "fecha").collect()]
    assert len(got) == len(set(got))
    assert sorted(got) == sorted(want)
