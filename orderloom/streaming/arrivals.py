"""Load CSV drops as they arrive.

The stream only notices new files; the batch load does the rest, so both share
the log and a file is loaded once whichever sees it first. A failed file that is
replaced under its old name is taken up by the next load, whatever starts it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import IngestOptions, ingest

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def load_arrivals(spark: SparkSession, landing: str, root: str,
                  options: IngestOptions = IngestOptions(),
                  clock: Callable[[], datetime] = utc_now,
                  once: bool = True) -> StreamingQuery:
    """Start loading; with ``once`` stop when every file now there is loaded.

    Only paths are read from the stream, never contents. Its checkpoint lies
    under the root, so a restarted query goes on where the last one stopped.
    """
    arrivals = (spark.readStream.format("binaryFile").schema(_FILES)
                .option("pathGlobFilter", "*.csv").load(landing).select("path"))

    def load(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            ingest(batch.sparkSession, landing, root, clock(), options)

    writer = (arrivals.writeStream.foreachBatch(load)
              .option("checkpointLocation", f"{root.rstrip('/')}/checkpoints/arrivals"))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(
        processingTime="1 minute")
    return writer.start()
