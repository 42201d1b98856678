"""Parse pages as they arrive, with the file source's own record of what was read.

The batch job finds new pages by comparing URL sets.  Run as a stream over the raw-page
folder, each trigger reads only files not read before, so its cost follows the new pages
and not the size of the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from forecourt.operators.extract import parse_listings
from forecourt.schemas import RAW_PAGES


def parse_stream(
    spark: SparkSession, raw_path: str, dictionary: DataFrame, out_path: str,
    checkpoint: str, as_of, files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Start parsing what is new under ``raw_path``; ends when it is all read.

    Each micro-batch owns one ``run``, ``batch`` partition of ``out_path`` and replaces it, so a batch
    repeated after a failure leaves its rows once.  The run is named after the checkpoint: a stream
    with another checkpoint, whose batches count from 0 again, replaces nothing.
    """
    run = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint.rstrip("/")).hex[:12]
    pages = (
        spark.readStream.schema(RAW_PAGES)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(raw_path)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = parse_listings(batch, dictionary, as_of)
        rows.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/run=r{run}/batch={batch_id}")

    return (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
