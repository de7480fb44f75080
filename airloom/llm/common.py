"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch that Python code looks at together. Bytes are bounded by ``chunks``.
BATCH_BYTES = 8 << 20


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_of(column: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def bounded_batches(spark: SparkSession, rows: int = 2000, size: int = 16 << 20) -> None:
    """Arrow batches of at most ``rows`` rows and about ``size`` bytes, whatever the texts' length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def remainder(id_column: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def one_label(labels: DataFrame, id_column: str, label: str) -> DataFrame:
    """(id, label) once per id; ids that are null, unlabelled or labelled both ways are left out."""
    return (
        labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
        .filter("id is not null and label in (0, 1)")
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
        .filter("label = _most").drop("_most")
    )


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of a piece stays near ``limit`` bytes; a longer text stands alone."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if len(sizes) > start:
            yield batch.slice(start)
