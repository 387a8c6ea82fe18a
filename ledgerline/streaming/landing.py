"""Incremental fundamentals load with Structured Streaming.

Newly landed company-facts documents are picked up by a file stream; every
micro-batch runs the same all-company plan on just the companies in that
batch and merges into the table store (the store keeps the last batch of each
stream, so a batch replayed after a failure changes nothing). Progress lives under the shared checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans.fundamentals import apply_to_store, build_tables
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.facts import COMPANY_FACTS_SCHEMA
from ledgerline.sources.submissions import read_submissions
from ledgerline.sources.symbols import read_ticker_map_json, ticker_map


def facts_stream(spark: SparkSession, landing_dir: str, multi_line: bool = True,
                 max_files: int = 1000) -> DataFrame:
    """Streaming read of company-facts documents as they land."""
    return (spark.readStream.schema(COMPANY_FACTS_SCHEMA).option("multiLine", multi_line)
            .option("maxFilesPerTrigger", max_files).json(landing_dir))


def start(spark: SparkSession, landing_dir: str, submissions_path: str, ticker_map_path: str, store: str,
          checkpoint: str | None = None, available_now: bool = True, multi_line: bool = True) -> StreamingQuery:
    """Start the incremental load; ``available_now`` processes what has landed and stops."""
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "streams", "fundamentals-landing")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        tmap = ticker_map(read_ticker_map_json(spark, ticker_map_path))
        subs = read_submissions(spark, submissions_path, multi_line)
        new = build_tables(spark, batch, subs, tmap, batch_id=int(batch_id))
        apply_to_store(spark, new, store, stream=ckpt, batch_id=int(batch_id))

    w = facts_stream(spark, landing_dir, multi_line).writeStream.foreachBatch(merge_batch) \
        .option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
