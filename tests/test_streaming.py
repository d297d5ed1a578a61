import os
import tempfile

from tests.test_files import HDR, _write
from workdays.streaming import continuous_load


def test_continuous_load_is_incremental_and_idempotent(spark, tmp_path):
    origen = tmp_path / "entrada"
    origen.mkdir()
    destino = str(tmp_path / "llamadas")
    ckpt = str(tmp_path / "ckpt")
    _write(origen / "201708 to_access.csv", HDR, [
        ["1/8/2017", "7:00:00", "1", "3", "s", "v", "ana", "r"],
        ["1/8/2017", "7:00:00", "1", "4", "s", "v", "ana", "r"],  # same key: first wins
        ["31/2/2017", "7:00:00", "2", "3", "s", "v", "bob", "r"],  # quarantined
    ])
    q = continuous_load.iniciar(spark, str(origen), destino, programa_id=17, checkpoint=ckpt,
                                destino_cuarentena=str(tmp_path / "cuar"), hasta_agotar=True)
    q.awaitTermination(120)
    assert spark.read.parquet(destino).count() == 1
    assert spark.read.parquet(str(tmp_path / "cuar")).count() == 1
    # a new file arrives, holding one already-stored key and one new call
    _write(origen / "201709 to_access.csv", HDR[:4] + ["CC"] + HDR[4:], [
        ["1/8/2017", "7:00:00", "1", "9", "x", "s", "v", "ana", "r"],
        ["2/9/2017", "8:00:00", "5", "7", "x", "s", "v", "cid", "r"],
    ])
    q = continuous_load.iniciar(spark, str(origen), destino, programa_id=17, checkpoint=ckpt, hasta_agotar=True)
    q.awaitTermination(120)
    t = spark.read.parquet(destino)
    assert t.count() == 2
    assert {r["log_name"] for r in t.collect()} == {"ana", "cid"}
    assert t.where("log_name = 'ana'").first()["dur"] == 3


def test_several_micro_batches_keep_the_first_row(spark, tmp_path):
    origen = tmp_path / "entrada"
    origen.mkdir()
    for k, dur in ((1, "3"), (2, "9"), (3, "7")):
        _write(origen / f"20170{k} to_access.csv", HDR, [
            ["1/8/2017", "7:00:00", "1", dur, "s", "v", "ana", "r"],  # same key in every file
            [f"{k}/8/2017", "8:00:00", str(k), "1", "s", "v", "bob", "r"],
        ])
    destino = str(tmp_path / "llamadas")
    q = continuous_load.iniciar(spark, str(origen), destino, programa_id=17, checkpoint=str(tmp_path / "ck"),
                                hasta_agotar=True, max_archivos=1)
    q.awaitTermination(180)
    t = spark.read.parquet(destino)
    assert t.where("log_name = 'ana'").count() == 1
    assert t.where("log_name = 'bob'").count() == 3
    assert len(q.recentProgress) >= 2  # processed over several micro-batches
