"""Join per-series values back to the rows without letting one hot series fill a task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
SALTS = 64


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL, as in a group; the key columns of ``left`` stay.

    Without keys ``right`` is a one-row table whose values become constants.
    """
    if not keys:
        return with_literals(left, right)
    theirs = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(theirs[f"_right_{k}"]) for k in keys]
    return left.join(theirs, on, how).drop(*[f"_right_{k}" for k in keys])


def row_bytes(table: DataFrame) -> int:
    """Estimated size of a row in memory: 8 bytes a field, 40 for a text, 400 for anything nested."""
    def size(kind: T.DataType) -> int:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return 40
        return 400 if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else 8

    return 16 + sum(size(f.dataType) for f in table.schema)


def with_literals(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Add the columns of a one-row table (a global aggregate) as constants."""
    only = table.first()
    return rows.withColumns(
        {f.name: F.lit(only[f.name]).cast(f.dataType) for f in table.schema}
    )


def attach(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    *,
    salt_on: Sequence[str],
    table_rows: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Add the columns of a *stored* one-row-per-key table to ``rows``.

    The table is counted first (a footer read) unless ``table_rows`` says its size. Up to
    ``broadcast_bytes`` (rows times their estimated size) it is broadcast; beyond that rows are spread over ``salts`` sub-keys
    and the table is repeated for each, so that a key with a third of the rows is still
    shared by many tasks. The sub-key also depends on the input partition, which spreads
    equal rows and stays the same when a task runs again.
    """
    if not keys:
        return with_literals(rows, table)
    count = table.count() if table_rows is None else table_rows
    if count * row_bytes(table) <= broadcast_bytes:
        return join_keys(rows, F.broadcast(table), keys)
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.hash(*salt_on) + F.spark_partition_id().cast("long"), F.lit(salts)).cast("int")
    salted = rows.withColumn("_salt", salt)
    return join_keys(salted, spread, [*keys, "_salt"]).drop("_salt")
