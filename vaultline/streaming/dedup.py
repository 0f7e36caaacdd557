"""Measurements from a stream whose repeats are found in the stream's own state.

Two ways lead to the table, and together they take every row:

* rows on time go through ``withWatermark`` and ``dropDuplicatesWithinWatermark``: the state store remembers each key
  for the watermark's delay, so a repeat costs no look at the table, and the rows are appended as they are;
* rows that the watermark calls late would be dropped by that operator. They are kept from the raw
  side of the stream and compared with the stored table, of which only the days they touch are read. So are rows without a
  time or with a NULL in the key, which no state can remember.

Spark's watermark is not visible to a micro-batch; the ledger keeps the latest event time of each epoch, and what is not
later than that of earlier epochs minus the delay counts as late. This bound is never below Spark's, so no row
falls between the two ways; a row that both take is stored once, since the late way looks at the table last.

A repeat is known for the delay after its first row; beyond that it is late itself. An epoch that died is run again
with the same rows: what the ledger has is left out, and a load that had begun is compared with the table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.temporal import ntz_literal
from ..operators.staging import stage_readings_only
from ..operators.vault import SAT_ASSET_MEASUREMENTS, measurement_rows
from ..operators.window import latest_by
from ..plans.measurements import store
from ..plans.sinks import read_or_none
from .ledger import BEGUN, DONE, Ledger, stream_name
from .loads import FILES_PER_TRIGGER, LEDGER, run_stream

# The five-part key of a measurement, as the readings name it (fixed list).
KEYS = ("asset_id", "interval_start", "interval_end", "reading_type", "creation_time")
EVENT, ON_TIME = "__event", "__on_time"


def _known(keys: Sequence[str]) -> Column:
    out = F.col(EVENT).isNotNull()
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def both_ways(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First rows by the stream's state (``__on_time``), and all rows as they come."""
    raw = stream.withColumn(EVENT, F.col(event_time).cast("timestamp"))
    first = raw.filter(_known(keys)).withWatermark(EVENT, delay).dropDuplicatesWithinWatermark(list(keys))
    return first.withColumn(ON_TIME, F.lit(True)).unionByName(raw.withColumn(ON_TIME, F.lit(False)))


def dedup_loader(root: str, checkpoint: str, keys: Sequence[str], event_time: str, delay: dt.timedelta):
    """The ``foreachBatch`` function of ``stream_dedup``."""
    table = SAT_ASSET_MEASUREMENTS.name
    path = f"{root.rstrip('/')}/{table}"
    first, later = f"{table}/on_time", f"{table}/late"

    def load(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        ledger = Ledger(spark, f"{root.rstrip('/')}/{LEDGER}", stream_name(spark, checkpoint))
        steps = ledger.steps(epoch)
        batch = batch.persist()  # bounded by the trigger's file limit
        try:
            top = batch.agg(F.max(event_time)).first()[0]  # takes in the whole batch, so the state is always committed
            if steps.get(first) != DONE:
                rows = stage_readings_only(batch.filter(F.col(ON_TIME)))
                # a load that began in an earlier attempt may be in the table
                existing = read_or_none(spark, path) if steps.get(first) == BEGUN else None
                ledger.note(epoch, first, BEGUN)
                store(spark, measurement_rows(rows, SAT_ASSET_MEASUREMENTS, existing, prune_days=True), path)
                ledger.note(epoch, first, DONE, top)
            if steps.get(later) != DONE:
                high = ledger.high(epoch, first)
                missed = ~_known(keys)
                if high is not None:
                    missed = missed | (F.col(event_time) <= ntz_literal(high - delay))
                rows = latest_by(batch.filter(~F.col(ON_TIME) & missed).drop(EVENT, ON_TIME), keys, [])
                rows = measurement_rows(stage_readings_only(rows), SAT_ASSET_MEASUREMENTS, read_or_none(spark, path), prune_days=True)
                store(spark, rows, path)
                ledger.note(epoch, later, DONE)
        finally:
            batch.unpersist()
    return load


def stream_dedup(spark: SparkSession, landing: str, schema, root: str, checkpoint: str, delay: dt.timedelta = dt.timedelta(days=1),
                 keys: Sequence[str] = KEYS, event_time: str = "creation_time", available_now: bool = True,
                 max_files_per_trigger: int = FILES_PER_TRIGGER) -> StreamingQuery:
    """Load readings that land as files into the day-partitioned measurements, each key once; returns the (finished) query.
    ``delay`` bounds the state: keys of that much event time are remembered."""
    delay = dt.timedelta(seconds=int(delay.total_seconds()))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing))
    out = both_ways(stream, keys, event_time, f"{int(delay.total_seconds())} seconds")
    load = dedup_loader(root, checkpoint, keys, event_time, delay)
    return run_stream(out.writeStream.outputMode("append").foreachBatch(load), checkpoint, available_now)
