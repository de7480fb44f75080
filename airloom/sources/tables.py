"""Stored tables: Parquet folders with overwrite, keyed upsert and partial-column merge.

A write puts its files into a folder of its own, never touched again; a monthly table has a folder per month
in there. A *snapshot* is a small file that names, for every month, the write that holds it, and is put in
place last by one rename. So a table changes as a whole: whatever fails before leaves the last snapshot, and a
reader keeps the files of the one it has resolved. An upsert writes only the months it touches, and its
snapshot takes over the others. The rename fails if another writer has taken the number, so of two writers that
started from one snapshot the second gets an error instead of undoing the first.

The file system must rename a file in one step, as HDFS and local disks do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.session import materialize

MONTH = "yyyy-MM"
PART = "part_month"  # not a feature name: `month` is one
WRITE = "part_write"
NO_MONTH = "none"  # rows without a time


def month_of(order: str) -> Column:
    return F.coalesce(F.date_format(order, MONTH), F.lit(NO_MONTH))


def latest_by_key(
    log: DataFrame, *, keys: Sequence[str] = ("city", "ts"), seq: Sequence[str] = ("seq",)
) -> DataFrame:
    """The last written row of each key. Map tasks keep one row per key before the shuffle,
    so a key that was written very often stays cheap. ``seq`` must order a key's rows."""
    window = W.partitionBy(*keys).orderBy(*[F.desc(s) for s in seq])
    return (
        log.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def upsert(
    old: DataFrame | None, new: DataFrame, *, keys: Sequence[str] = ("city", "ts"),
    seq: str | None = None, keep: str = "last",
) -> DataFrame:
    """``new`` over ``old``: every column of a rewritten key is replaced, NULLs included.

    ``seq`` orders rewrites within ``new``; without it the keys of ``new`` must be unique. With
    ``keep="first"`` it is the other way round: old rows stay, and of new ones the lowest ``seq``,
    which is then stored, too.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"unknown keep {keep!r}")
    order = F.col(seq).cast("long") if seq else F.lit(0).cast("long")
    fresh = new.withColumn("_seq", order if keep == "last" else -order)
    if seq and keep == "last":
        fresh = fresh.drop(seq)
    if old is None:
        return latest_by_key(fresh, keys=keys, seq=("_seq",)).drop("_seq")
    stale = old.select(*fresh.drop("_seq").columns).withColumn(
        "_seq", F.lit(-(2**62) if keep == "last" else 2**62).cast("long")
    )
    return latest_by_key(stale.unionByName(fresh), keys=keys, seq=("_seq",)).drop("_seq")


def merge_columns(
    old: DataFrame, new: DataFrame, *, key: str, keep_first: Sequence[str] = ()
) -> DataFrame:
    """Full outer merge on ``key`` that touches only the columns ``new`` carries.

    A column present on both sides takes the new value where there is one, except the
    ``keep_first`` columns, which keep the old value where there is one.
    """
    columns = [*old.columns, *[c for c in new.columns if c not in old.columns]]

    def merged(c: str):
        if c not in new.columns:
            return F.col(f"o.{c}")
        if c not in old.columns:
            return F.col(f"n.{c}")
        pair = (f"o.{c}", f"n.{c}") if c in keep_first else (f"n.{c}", f"o.{c}")
        return F.coalesce(*[F.col(p) for p in pair])

    joined = old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    return joined.select(*[merged(c).alias(c) for c in columns])


class ConcurrentWrite(RuntimeError):
    """Another writer has changed the table meanwhile; nothing of this write is visible."""


class Table:
    """One stored Parquet table; with ``monthly`` it is partitioned by the month of ``order``."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType | None = None, *,
        monthly: bool = False, order: str = "ts",
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.monthly = monthly
        self.order = order

    # --- snapshots

    def _fs(self):
        root = self._at("")
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, inside: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{inside}" if inside else self.path)

    def _names(self, inside: str) -> list[str]:
        fs, folder = self._fs(), self._at(inside)
        return [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("snapshots") if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, number: int) -> dict:
        stream = self._fs().open(self._at(f"snapshots/{number:010d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def snapshot(self) -> dict | None:
        """The live state: ``number``, ``schema``, ``parts`` (month, or nothing -> write) and ``marks``; None before
        the first write."""
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else None

    def _commit(self, state: dict) -> None:
        """Make ``state`` the live one, unless its number is taken."""
        jvm = self.spark._jvm
        target, aside = self._at(f"snapshots/{state['number']:010d}.json"), self._at(f"snapshots/.{uuid.uuid4().hex}")
        out = self._fs().create(aside, False)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs().makeQualified(target).toUri(), self.spark._jsc.hadoopConfiguration())
        never_over = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(aside, target, never_over)
        except Exception as e:
            self._fs().delete(aside, False)
            if "FileAlreadyExists" in str(e):
                raise ConcurrentWrite(f"{self.path} has changed since snapshot {state['number'] - 1}") from e
            raise
        self._forget(state)

    def _forget(self, live: dict) -> None:
        """Remove snapshots before the last one, which may still be read, and the months that only they name."""
        old = [n for n in self._numbers() if n < live["number"] - 1]
        if not old:
            return
        last = self._load(live["number"] - 1)
        kept = {*live["parts"].items(), *last["parts"].items()}
        fs = self._fs()
        for number in old:
            for part, write in self._load(number)["parts"].items():
                if (part, write) not in kept:
                    fs.delete(self._at(self._folder(part, write)), True)
                if all(write != w for _, w in kept):
                    fs.delete(self._at(f"data/{WRITE}={write}"), True)
                    fs.delete(self._at(f"lengths/{WRITE}={write}"), True)
            fs.delete(self._at(f"snapshots/{number:010d}.json"), False)

    def vacuum(self) -> list[str]:
        """Remove what failed writes have left behind; not while another writer is at work."""
        numbers = self._numbers()
        named = {w for n in numbers for w in self._load(n)["parts"].values()}
        fs, gone = self._fs(), []
        for kind in ("data", "lengths"):
            for name in self._names(kind):
                if name.removeprefix(f"{WRITE}=") not in named:
                    fs.delete(self._at(f"{kind}/{name}"), True)
                    gone.append(f"{kind}/{name}")
        for name in self._names("snapshots"):
            if name.startswith(".") and not name.endswith(".crc"):
                fs.delete(self._at(f"snapshots/{name}"), False)
                gone.append(f"snapshots/{name}")
        return gone

    @staticmethod
    def _folder(part: str, write: str) -> str:
        return f"data/{WRITE}={write}/{PART}={part}" if part else f"data/{WRITE}={write}"

    # --- reading

    def exists(self) -> bool:
        return bool(self._numbers())

    def _scan(self, state: dict, months: Sequence[str] | None = None) -> DataFrame:
        """The rows of a snapshot, or of some of its months, with their month."""
        schema = self.schema or T.StructType.fromJson(json.loads(state["schema"]))
        read_as = T.StructType([*schema]).add(WRITE, "string")
        if self.monthly:
            read_as = read_as.add(PART, "string")
        paths = [f"{self.path}/{self._folder(p, w)}" for p, w in state["parts"].items() if months is None or p in months]
        if not paths:
            return self.spark.createDataFrame([], read_as).drop(WRITE)
        return self.spark.read.schema(read_as).option("basePath", f"{self.path}/data").parquet(*paths).drop(WRITE)

    def read(self, since=None, until=None) -> DataFrame:
        """The rows, optionally with ``since <= order < until`` (times or columns).

        The bounds also prune month folders. A table never written reads as empty if its
        schema is fixed.
        """
        state = self.snapshot()
        if state is None:
            if self.schema is None:
                raise FileNotFoundError(f"{self.path} was never written and has no fixed schema")
            return self.spark.createDataFrame([], self.schema)
        df = self._scan(state)
        for bound, below in ((since, False), (until, True)):
            if bound is None:
                continue
            at = bound if isinstance(bound, Column) else F.lit(bound)
            at = at.cast("timestamp_ntz")
            df = df.filter(F.col(self.order) < at if below else F.col(self.order) >= at)
            if self.monthly:
                month = F.date_format(at, MONTH)
                df = df.filter(F.col(PART) <= month if below else F.col(PART) >= month)
        return df.drop(PART) if self.monthly else df

    def lengths(self, keys: Sequence[str] = ("city",)) -> DataFrame:
        """Rows, first and last ``order`` of every series, from a side table with a row per series, month and write.

        Files of a write never change, so its share is counted once, by the first call after the write. Operators
        on series take the result as ``split``, for this table or anything with no more rows per series.
        """
        state = self.snapshot()
        if state is None:
            raise FileNotFoundError(f"{self.path} was never written")
        name = "-".join(keys) or "all"
        kept = []
        for write in sorted(set(state["parts"].values())):
            folder = f"lengths/{WRITE}={write}/{name}"
            parts = [p for p, w in state["parts"].items() if w == write]
            if not self._fs().exists(self._at(f"{folder}/_SUCCESS")):
                by = [*keys, *([PART] if self.monthly else [])]
                counted = self._scan(state, parts).groupBy(*by).agg(
                    F.count(F.lit(1)).alias("rows"), F.min(self.order).alias("first"), F.max(self.order).alias("last"))
                counted.write.mode("overwrite").parquet(f"{self.path}/{folder}")
            found = self.spark.read.parquet(f"{self.path}/{folder}")
            kept.append(found.filter(F.col(PART).isin(parts)).drop(PART) if self.monthly else found)
        if not kept:
            return self._scan(state).groupBy(*keys).agg(
                F.count(F.lit(1)).alias("rows"), F.min(self.order).alias("first"), F.max(self.order).alias("last"))
        together = kept[0]
        for more in kept[1:]:
            together = together.unionByName(more)
        return together.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"))

    # --- writing

    def overwrite(self, df: DataFrame) -> DataFrame:
        """Replace the whole content; ``df`` may read this table."""
        self._write(df, self.snapshot(), None)
        return self.read()

    def _write(self, df: DataFrame, state: dict | None, replaced: Sequence[str] | None, marks: dict | None = None) -> None:
        """Write ``df`` aside and make it live, in place of all months or of the ``replaced`` ones of ``state``."""
        write = uuid.uuid4().hex
        folder = f"{self.path}/data/{WRITE}={write}"
        if self.monthly:
            # Rebalancing splits large months over several tasks and merges small remainders.
            dated = df.withColumn(PART, month_of(self.order)).hint("rebalance", PART)
            dated.write.partitionBy(PART).parquet(folder)
            parts = [n.removeprefix(f"{PART}=") for n in self._names(f"data/{WRITE}={write}") if n.startswith(f"{PART}=")]
        else:
            df.write.parquet(folder)
            parts = [""]
        kept = {} if replaced is None or state is None else {p: w for p, w in state["parts"].items() if p not in replaced}
        self._commit({"number": (state["number"] if state else 0) + 1, "schema": df.schema.json(),
                      "parts": {**kept, **dict.fromkeys(parts, write)},
                      "marks": marks if marks is not None else (state or {}).get("marks", {})})

    def fold(
        self, new: DataFrame, combine: Callable[[DataFrame | None, DataFrame], DataFrame], *, marks: dict | None = None,
    ) -> DataFrame:
        """Replace the months that ``new`` touches, or a table that is not monthly, by ``combine(old rows, new)``.

        All of them change at once, together with the ``marks`` of the snapshot: small facts, such as how far
        a stream has got.
        """
        state = self.snapshot()
        if state is None or not self.monthly:
            self._write(combine(self._scan(state) if state else None, new), state, None, marks)
            return self.read()
        touched = new.select(month_of(self.order).alias(PART)).distinct()
        months = [r[PART] for r in touched.collect()]  # bounded by the covered time range
        self._write(combine(self._scan(state, months).drop(PART), new), state, months, marks)
        return self.read()

    def upsert(
        self, new: DataFrame, *, keys: Sequence[str] = ("city", "ts"), seq: str | None = None,
        keep: str = "last",
    ) -> DataFrame:
        """Last writer wins on ``keys``, or the first one with ``keep="first"``.

        A monthly table writes only the months that ``new`` touches; all of them change at once.
        """
        return self.fold(new, lambda old, fresh: upsert(old, fresh, keys=keys, seq=seq, keep=keep))

    def merge(self, new: DataFrame, *, key: str, keep_first: Sequence[str] = ()) -> DataFrame:
        """Update only the columns ``new`` carries."""
        return self.overwrite(merge_columns(self.read(), new, key=key, keep_first=keep_first))

    def lookup(self, **equal) -> DataFrame:
        """Rows with the given column values; the filter reaches the Parquet scan."""
        df = self.read()
        for column, value in equal.items():
            df = df.filter(F.col(column) == value)
        return df

    def is_empty(self) -> bool:
        return not self.exists() or self.read().isEmpty()


class Warehouse:
    """The tables of one deployment under a common folder."""

    def __init__(self, spark: SparkSession, root: str):
        from airloom import schemas

        self.spark, self.root = spark, root.rstrip("/")

        def table(name, schema=None, monthly=False):
            return Table(spark, f"{self.root}/{name}", schema, monthly=monthly)

        self.raw_weather = table("raw_weather", schemas.RAW_WEATHER, monthly=True)
        self.raw_aqi = table("raw_aqi", schemas.RAW_AQI, monthly=True)
        self.preprocessed = table("preprocessed_data", monthly=True)
        self.features = table("feature_store", monthly=True)
        self.feature_metadata = table("feature_metadata", schemas.FEATURE_METADATA)
        self.model_registry = table("model_registry", schemas.MODEL_REGISTRY)
        self.predictions = table("aqi_predictions", monthly=True)
        self.models_dir = f"{self.root}/models"
        self.comparison_path = f"{self.root}/model_comparison.csv"


def preprocessed_or_joined(warehouse: Warehouse) -> DataFrame:
    """The preprocessed table, or the joined raw tables while it is empty."""
    from airloom.operators.joins import merge_readings

    if not warehouse.preprocessed.is_empty():
        return warehouse.preprocessed.read()
    return merge_readings(warehouse.raw_weather.read(), warehouse.raw_aqi.read())
