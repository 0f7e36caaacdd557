"""Micro-batch versions of the vault loads (Structured Streaming).

New reading files arrive in a landing folder; a file-source stream picks them
up (its checkpoint records which files were consumed) and ``foreachBatch``
runs the same hub / link / satellite / measurement loaders as the batch build
against the stored tables. The loaders anti-join against what is stored, so
replaying a micro-batch after a failure appends nothing twice, and a ledger (``ledger.py``) lets it resume at the
table it had reached. ``stream_load`` has no watermark: a
reading is loaded however late it comes. Repeats inside a batch are reduced to one row, and
those of earlier batches are in the target. ``stream_dedup`` (``dedup.py``) finds them in the stream's own state instead.

``trigger(availableNow=True)`` processes what has landed and stops, which is
how a scheduled loader runs; ``processingTime`` keeps it running.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.staging import seen_rows, stage_asset_span, stage_readings, stage_readings_only
from ..operators.vault import (HUBS, LINKS, SAT_ASSET_MEASUREMENTS, SATELLITES, hub_rows,
                               link_rows, measurement_rows)
from ..operators.window import latest_by
from ..plans import measurements
from ..plans.build import _load_satellite
from ..plans.sinks import append, read_or_none
from .ledger import DONE, Ledger, stream_name

BINDINGS = {b.name: b for b in (*HUBS, *LINKS, *SATELLITES, SAT_ASSET_MEASUREMENTS)}
KEYED = {b.name for b in (*HUBS, *LINKS)}

FILES_PER_TRIGGER = 1000

Dimensions = Callable[[], tuple[DataFrame, DataFrame, DataFrame]]


class Staged(NamedTuple):
    """What a micro-batch's loads read; ``reduced``: it is at asset grain."""
    rows: DataFrame
    reduced: bool


def _load_one(spark: SparkSession, batch: Staged, name: str, root: str) -> None:
    b, (staged, reduced) = BINDINGS[name], batch
    path = f"{root.rstrip('/')}/{name}"
    existing = read_or_none(spark, path)
    if name in {h.name for h in HUBS}:
        rows = hub_rows(staged, b, existing, reduced)
    elif name in {ln.name for ln in LINKS}:
        rows = link_rows(staged, b, existing, reduced)
    elif name == SAT_ASSET_MEASUREMENTS.name:
        measurements.store(spark, measurement_rows(staged, b, existing, prune_days=True), path)
        return
    else:  # versions against the maintained current-version table, as in the batch build
        _load_satellite(spark, root, staged, b, existing)
        return
    append(rows, path)


LEDGER = "_ledger"


def batch_loader(tables: Sequence[str], root: str, dimensions: Dimensions | None = None,
                 dedup_keys: Sequence[str] | None = None, event_time: str | None = None,
                 checkpoint: str | None = None):
    """The ``foreachBatch`` function: stage the micro-batch, run each load that the ledger does not have for this epoch.
    Dimension tables of the lake hold row versions; each key's current one is used. Without a ``checkpoint``
    there is no ledger: every load runs."""
    def load(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        ledger = Ledger(spark, f"{root.rstrip('/')}/{LEDGER}", stream_name(spark, checkpoint)) if checkpoint else None
        steps = ledger.steps(epoch_id) if ledger else {}
        open_tables = [name for name in tables if steps.get(name) != DONE]
        if not open_tables:
            return
        if dedup_keys:
            batch = latest_by(batch, dedup_keys, [event_time] if event_time else [])
        # hubs and links need the first row per asset alone, as in the batch build; the others every reading
        keyed = [name for name in open_tables if name in KEYED] if dimensions is not None else []
        detailed = [name for name in open_tables if name not in keyed]
        inputs = []
        if keyed:
            inputs.append((keyed, seen_rows(stage_asset_span(batch, *dimensions(), dedup_sources=True), "first")))
        if detailed:
            inputs.append((detailed, stage_readings(batch, *dimensions(), dedup_sources=True) if dimensions is not None
                           else stage_readings_only(batch)))
        for names, staged in inputs:
            # each table reads its own columns; a load of one table but the measurements (which look at the batch's days
            # first) reads them once and needs no copy
            wanted = {c for name in names for c in BINDINGS[name].columns}
            staged = staged.select(*[c for c in staged.columns if c in wanted])
            kept = len(names) > 1 or SAT_ASSET_MEASUREMENTS.name in names
            if kept:
                staged = staged.persist()  # bounded by the trigger's file limit; recomputed if an executor is lost
            try:
                for name in names:
                    _load_one(spark, Staged(staged, names is keyed), name, root)
                    if ledger:
                        ledger.note(epoch_id, name, DONE)
            finally:
                if kept:
                    staged.unpersist()
    return load


def stream_load(spark: SparkSession, landing: str, schema, root: str, checkpoint: str,
                tables: Sequence[str], dimensions: Dimensions | None = None,
                dedup_keys: Sequence[str] | None = None, event_time: str | None = None,
                available_now: bool = True,
                max_files_per_trigger: int = FILES_PER_TRIGGER) -> StreamingQuery:
    """Run the streaming load over ``landing`` and return the (finished) query.

    ``dedup_keys`` reduce repeats inside a micro-batch to the row with the latest ``event_time``.
    ``max_files_per_trigger`` bounds a micro-batch.
    """
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(landing))
    load = batch_loader(tables, root, dimensions, dedup_keys, event_time, checkpoint)
    return run_stream(stream.writeStream.foreachBatch(load), checkpoint, available_now)


def run_stream(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    """Start a stream; ``available_now`` waits until what has landed is processed, and raises its failure."""
    w = writer.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return q
