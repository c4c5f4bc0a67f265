"""The Bronze stream: a stateless map from bus messages to Bronze files.

Each micro-batch is appended under ``event_date=/event_type=`` and
summarised per event type; an empty batch writes nothing. By default the
summary is collected with ``observe`` during the write itself (one pass,
nothing cached); ``cache_batches=True`` instead persists the batch, counts
and summarises it from the cache, writes, and releases it. The checkpoint holds offsets only
(no state), so a restart resumes after the last committed batch. A batch is
published under a key of the checkpoint's query id and the batch number, so
a batch replayed after a driver failure between write and commit is finished
or skipped, never appended twice.
"""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from triplake.config import LakeConfig
from triplake.operators import bronze as B
from triplake.sinks import lake as sink
from triplake.sinks.publish import Files

log = logging.getLogger(__name__)


def batch_writer(bronze_path: str, cfg: LakeConfig = LakeConfig(), summaries: list | None = None,
                 cache_batches: bool = False, checkpoint: str | None = None):
    """Build the ``foreachBatch`` callback; without ``checkpoint`` batches have no key and a replayed one is appended again."""

    def key(batch_df: DataFrame, batch_id: int) -> str | None:
        if checkpoint is None:
            return None
        query = json.loads(Files(batch_df.sparkSession, checkpoint).read(f"{checkpoint}/metadata"))["id"]
        return f"stream-{query}-{batch_id}"

    def write_observed(batch_df: DataFrame, batch_id: int) -> None:
        # emptiness probe stops at the first valid row; the counts come from
        # the write's own pass
        if batch_df.isEmpty():
            return
        # unique name: an observation is filled from whichever query reports
        # a metric of its name, and concurrent streams share batch ids
        obs = Observation(f"bronze_batch_{batch_id}_{uuid.uuid4().hex[:8]}")
        observed = batch_df.observe(obs, *[
            F.count_if(F.col("event_type") == t).alias(t) for t in cfg.event_types])
        if not sink.append_bronze(observed, bronze_path, cfg, key(batch_df, batch_id)):
            log.info("batch %s: landed before", batch_id)
            return
        counts = sorted((t, n) for t, n in obs.get.items() if n)
        total = sum(n for _, n in counts)
        log.info("batch %s: wrote %s events to Bronze %s", batch_id, total, counts)
        if summaries is not None:
            summaries.append((batch_id, total, counts))

    def write_cached(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            # the per-type summary (<= 6 rows) is the first action: it fills
            # the cache and yields the total, so no separate count/emptiness job
            counts = [(r["event_type"], r["count"]) for r in B.event_counts(batch_df).collect()]
            total = sum(n for _, n in counts)
            if total == 0:
                return
            if not sink.append_bronze(batch_df, bronze_path, cfg, key(batch_df, batch_id)):
                log.info("batch %s: landed before", batch_id)
                return
            log.info("batch %s: wrote %s events to Bronze %s", batch_id, total, counts)
            if summaries is not None:
                summaries.append((batch_id, total, counts))
        finally:
            batch_df.unpersist()

    return write_cached if cache_batches else write_observed


def start(raw_stream: DataFrame, bronze_path: str, checkpoint: str,
          cfg: LakeConfig = LakeConfig(), available_now: bool = False,
          interval: str | None = None, summaries: list | None = None,
          cache_batches: bool = False) -> StreamingQuery:
    """Start the stream; ``available_now`` drains what is there and stops."""
    w = (
        B.transform(raw_stream, cfg)
        .writeStream.foreachBatch(batch_writer(bronze_path, cfg, summaries, cache_batches, checkpoint))
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        w = w.trigger(availableNow=True)
    else:
        from triplake.config import TRIGGER_INTERVAL
        w = w.trigger(processingTime=interval or TRIGGER_INTERVAL)
    return w.start()


def run_available(raw_stream: DataFrame, bronze_path: str, checkpoint: str,
                  cfg: LakeConfig = LakeConfig(), summaries: list | None = None,
                  timeout_s: int = 1800, cache_batches: bool = False) -> None:
    """Bounded run: land everything available, then return."""
    q = start(raw_stream, bronze_path, checkpoint, cfg, available_now=True, summaries=summaries,
              cache_batches=cache_batches)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream did not drain within {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
