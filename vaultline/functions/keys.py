"""Hash keys and hash diffs (Data Vault 2.0), as JVM-side Column expressions.

Semantics: upper-case hex MD5 over the UTF-8 bytes of the column values rendered
as text, NULL rendered as the empty string, values joined by a two-pipe
separator (a single column has none). NULL and '' therefore hash alike, and a
separator inside a value can collide; both are properties of the scheme.

Rendering must be identical in every engine that recomputes a key, so types
whose default text differs between engines get a fixed format:
timestamps always carry six fractional digits, dates are ISO.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The separator between rendered columns and the timestamp text
# layout used inside hashes.
SEPARATOR = "||"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DATE_TEXT = "yyyy-MM-dd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Render one value as hash input text (NULL stays NULL here)."""
    col = _col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, TIMESTAMP_TEXT)
    if isinstance(dtype, T.DateType):
        return F.date_format(col, DATE_TEXT)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        raise TypeError("floating point columns render differently across engines; "
                        "cast to decimal before hashing")
    return col.cast("string")


def hash_of(*texts: Column) -> Column:
    """MD5 hex (upper case) of already rendered text columns."""
    parts = [F.coalesce(t, F.lit("")) for t in texts]
    body = parts[0] if len(parts) == 1 else F.concat_ws(SEPARATOR, *parts)
    return F.upper(F.md5(body))


def hash_key(*cols: str | Column, schema: T.StructType | None = None) -> Column:
    """Hash key over columns; pass ``schema`` so timestamps/dates get fixed text."""
    if not cols:
        raise ValueError("hash_key needs at least one column")
    texts = []
    for c in cols:
        dtype = schema[c].dataType if (schema is not None and isinstance(c, str)) else None
        texts.append(as_text(c, dtype))
    return hash_of(*texts)


def hash_diff(*cols: str | Column, schema: T.StructType | None = None) -> Column:
    """Hash diff of a satellite payload: the same function as ``hash_key``."""
    return hash_key(*cols, schema=schema)


def with_hash(df: DataFrame, name: str, cols: list[str]) -> DataFrame:
    """Add ``name`` = hash over ``cols`` of ``df`` (types read from the schema)."""
    return df.withColumn(name, hash_key(*cols, schema=df.schema))
