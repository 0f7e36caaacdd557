"""What each epoch of a stream has loaded: a record per (stream, epoch, table), committed after the load.

A micro-batch that dies is run again by Spark, with the same rows and the same epoch. The ledger tells which of
its tables are loaded already, so the run resumes at the table it had reached. A record that a load was begun comes before
it; a load that was begun but not finished may have appended its rows, so it alone is compared with what is stored.

Epochs count from 0 for each checkpoint, so the stream is named by the query id that its checkpoint holds: a new checkpoint
is a new stream.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.journal import Journal

SCHEMA = T.StructType([
    T.StructField("stream", T.StringType()), T.StructField("epoch", T.LongType()), T.StructField("table_name", T.StringType()),
    T.StructField("step", T.StringType()), T.StructField("high", T.TimestampNTZType()), T.StructField("at", T.TimestampNTZType())])
BEGUN, DONE = "begun", "done"


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns the checkpoint (written before its first micro-batch)."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


class Ledger(Journal):
    def __init__(self, spark: SparkSession, path: str, stream: str):
        super().__init__(spark, path, SCHEMA)
        self.stream = stream

    def needed(self, rows):
        """Of epochs before a stream's last two only the highest time is asked for."""
        last = rows.groupBy("stream").agg((F.max("epoch") - 1).alias("last"))
        marked = rows.join(last, "stream")
        recent = marked.filter("epoch >= last").drop("last").distinct()
        older = marked.filter("epoch < last").groupBy("stream", "table_name").agg(
            F.max("epoch").alias("epoch"), F.max("high").alias("high"), F.max("at").alias("at"))
        return recent.unionByName(older.withColumn("step", F.lit(DONE)))

    def steps(self, epoch: int) -> dict[str, str]:
        """Per table of this epoch how far its load got (one row per table at most)."""
        rows = self.frame().filter((F.col("stream") == self.stream) & (F.col("epoch") == epoch))
        return {r.table_name: r.step for r in rows.groupBy("table_name").agg(F.max("step").alias("step")).collect()}

    def high(self, epoch: int, table: str) -> dt.datetime | None:
        """The latest event time that epochs before this one recorded for the table."""
        rows = self.frame().filter((F.col("stream") == self.stream) & (F.col("epoch") < epoch) & (F.col("table_name") == table))
        return rows.agg(F.max("high")).first()[0]

    def note(self, epoch: int, table: str, step: str, high: dt.datetime | None = None) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.append((self.stream, epoch, table, step, high, now))
