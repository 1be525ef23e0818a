"""Continuous / scheduled loading of a landing folder with Structured Streaming.

New files in the landing folder are picked up once each (the file source
keeps the list of processed files in the checkpoint).  Every micro-batch
runs the same batch transform as the daily job: keep rows the target does
not hold (null-safe anti-join on the business key), clean, stamp, append.
Because the anti-join reads the target, a micro-batch that is replayed
after a failure appends nothing twice: the sink is idempotent.

``Trigger.AvailableNow`` processes everything that has landed and stops,
which is the daily-batch schedule; a processing-time trigger turns the
same code into a continuous loader.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerline.jobs.order_loader import LoaderConfig, transform
from ledgerline.operators.columns import rename_map
from ledgerline.operators.lifecycle import Run
from ledgerline.operators.staging import staged
from ledgerline.sources.readers import read_existing


def start_landing_loader(spark: SparkSession, landing_dir: str, schema: StructType, cfg: LoaderConfig,
                         target_path: str, checkpoint_location: str, job: str = "landing_loader",
                         fmt: str = "parquet", available_now: bool = True,
                         processing_time: str | None = None, max_files_per_trigger: int | None = None,
                         **read_options):
    """Start the stream; returns the ``StreamingQuery``.

    ``checkpoint_location`` (shared storage, the same for every start of this
    stream) remembers which files were read; without it each session would
    read the whole landing folder again."""
    reader = spark.readStream.schema(schema).format(fmt).options(**read_options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_dir)

    def process(batch: DataFrame, epoch_id: int) -> None:
        from ledgerline.sources.sinks import append_table
        batch = staged(batch, "micro-batch")  # it is read for its keys and for its rows
        stored = read_existing(spark, target_path)
        history = None if stored is None else stored.select(*cfg.key)
        if history is None:  # first load: an empty history with the key's types
            history = rename_map(batch, cfg.rename).select(*cfg.key).limit(0)
        run = Run(job=job, run_id=f"{job.upper()}-{epoch_id:08d}",
                  started=_dt.datetime.now().replace(microsecond=0))
        append_table(transform(batch, history, cfg, run), target_path)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
