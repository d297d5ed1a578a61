"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied when this library builds the session itself (tests, bench).
# On a cluster the submitter's settings win: ``getOrCreate`` keeps an existing session.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # partitionBy writes replace only the partitions they touch (K4)
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "workdays") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only in local mode, when it is unset (tests), is a scratch
    folder made. On a cluster an unset value is an error, never a machine-local path.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder every executor can reach"
            )
        current = tempfile.mkdtemp(prefix="workdays-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def carpeta_de_trabajo(spark: SparkSession, nombre: str) -> str:
    """A fresh folder for intermediate data under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{nombre}/{uuid.uuid4().hex}"


def borrar_carpeta(spark: SparkSession, ruta: str) -> None:
    """Delete a folder of intermediate data, in whatever file system it is."""
    camino = spark._jvm.org.apache.hadoop.fs.Path(ruta)
    camino.getFileSystem(spark._jsc.hadoopConfiguration()).delete(camino, True)
