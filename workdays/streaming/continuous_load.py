"""Continuous load: new delimited files in a folder -> the calls table.

The streaming form of the ingest (X3): a file source picks up files as they
land; each micro-batch is aligned by header, normalised, tagged with its
programme and loaded with insert-ignore. Because the load skips keys already
stored and the quarantine of a file replaces itself, a micro-batch that is
re-run after a failure writes nothing twice.
Progress lives in a checkpoint under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import LOAD_NAME_END
from ..plans import ingest
from ..session import ensure_checkpoint_dir
from ..sources import files

# Files taken into one micro-batch unless the caller says otherwise: a backlog is worked off in parts.
MAX_ARCHIVOS = 1000


def iniciar(
    spark: SparkSession,
    origen: str,
    destino: str,
    programas: DataFrame | None = None,
    programa_id: int | None = None,
    destino_cuarentena: str | None = None,
    checkpoint: str | None = None,
    patron_archivo: str = f"?????? *{LOAD_NAME_END}",
    patron_nombre: str = files.CARGA_RE,
    sep: str = ";",
    encoding: str = "UTF-8",
    hasta_agotar: bool = False,
    intervalo: str = "1 minute",
    max_archivos: int = MAX_ARCHIVOS,
) -> StreamingQuery:
    """Start the continuous load and return the running query.

    ``hasta_agotar`` processes what is there now and stops (``availableNow``);
    otherwise a micro-batch runs every ``intervalo``. A micro-batch takes at most
    ``max_archivos`` files. The default checkpoint belongs to this pair of folders.
    """
    if checkpoint is None:
        par = hashlib.sha256(f"{origen}\n{destino}".encode()).hexdigest()[:16]
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/carga_continua/{par}"
    reader = (
        spark.readStream.schema("_linea string")
        .options(**files.OPCIONES_LINEA)
        .option("encoding", encoding)
        .option("pathGlobFilter", patron_archivo)
        .option("maxFilesPerTrigger", max_archivos)
    )
    stream = files.con_origen(reader.csv(origen))

    def por_lote(lote: DataFrame, epoch_id: int) -> None:
        lineas = lote.withColumn("_fila", F.monotonically_increasing_id())
        partidas = files.partir(lineas, files.ancho_de_cabeceras(lineas, sep), sep)
        crudo = files.alinear(partidas, patron_nombre)
        leidos = lineas.select(F.col("_ruta").alias("ruta"), F.lit(None).cast("string").alias("archivo")).distinct()
        ingest.ingerir(lote.sparkSession, destino, crudo, programas, programa_id, destino_cuarentena, leidos=leidos)

    w = stream.writeStream.foreachBatch(por_lote).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if hasta_agotar else w.trigger(processingTime=intervalo)
    return w.start()
