"""Reading the input tables, cutting lineage, and small column helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again: later
    plans start from the files, which any executor can read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete stored tables that nothing will read again (all that came of them is stored too)."""
    for df in frames:
        delete_path(df.sparkSession, df.stored_at)


def held_out(doc_id: Column, mod: int, rest: int = 2) -> Column:
    """Whether ``crc32(doc_id as text) mod`` is ``rest`` (a null id: never)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(False))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` whose result follows ``schema`` whatever the batch's own nullability is."""
    to = to_arrow(schema)

    def run(batches):
        for out in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [out.column(f.name).cast(f.type) if out.column(f.name).type != f.type
                 else out.column(f.name) for f in to], schema=to)
    return df.mapInArrow(run, schema)


def to_arrow(schema: str) -> pa.Schema:
    """Arrow schema of a DDL string of flat columns and arrays of them."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
             "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}

    def of(t: T.DataType) -> pa.DataType:
        if isinstance(t, T.ArrayType):
            return pa.list_(of(t.elementType))
        if isinstance(t, T.StructType):
            return pa.struct([(f.name, of(f.dataType)) for f in t.fields])
        return kinds[t.simpleString()]
    return pa.schema([(f.name, of(f.dataType)) for f in T._parse_datatype_string(schema).fields])
