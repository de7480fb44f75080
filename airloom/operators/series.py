"""Order-dependent building blocks that never put an overlong series into one task.

A window over ``PARTITION BY city`` sends every row of a city to one task. That is the
cheapest plan (one shuffle) while every series fits a task, so the longest series is
measured first: a count over the key columns, combined map-side. Beyond
``MAX_SERIES_ROWS`` a series is cut along time instead:

* *buckets* (city, span of time) are what rows are shuffled and sorted by;
* whatever has to cross a bucket edge (row offsets, last known values) is first reduced to
  one row per bucket, run through a window over that small table, and joined back;
* row-framed windows run over *blocks* of consecutive buckets with about equally many
  rows, and each block also receives the buckets before it that its first frames reach.

A bucket spans 30 days (720 hourly readings), or as much less as it takes for the densest
one to fit a task; ``bucket_seconds`` fixes the span.

The small tables are stored, so that the planner knows their size: within the broadcast
threshold the rows are shuffled just once, beyond it they are joined by (city, bucket). Rows
without a city are a series of their own in every form: keys are compared with NULL equal to NULL.

Measuring reads the key columns of the input, and nothing is stored for it; the counts that a stored table
keeps beside itself (``Table.lengths``) save that pass, too. Where making the input is expensive, store it first.

``split`` says how: None measures, a frame of lengths (keys, ``rows``) is used instead, True always cuts, and False
never does. (keys, order) must identify a row, as it does after the keyed upsert.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.functions.expr import epoch_micros, epoch_seconds
from airloom.operators.attach import join_keys
from airloom.session import materialize

SPANS = (30 * 86400, 86400, 3600, 60, 1)
BLOCK_ROWS = 50_000
MAX_SERIES_ROWS = 1_000_000
_NULL_BUCKET = -(2**62)


def bucket_of(order: str, seconds: int) -> Column:
    """Span of time a row falls in; rows without a time sort first, as in a window."""
    return F.coalesce(
        F.floor(epoch_seconds(order) / F.lit(seconds)).cast("long"), F.lit(_NULL_BUCKET)
    )


def must_split(df: DataFrame, keys: Sequence[str], split: bool | DataFrame | None = None) -> bool:
    """Whether some series is too long for one task."""
    if isinstance(split, bool):
        return split
    if split is None:
        lengths = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    else:
        lengths = split.groupBy(*keys).agg(F.sum("rows").alias("rows"))
    return (lengths.agg(F.max("rows")).first()[0] or 0) > MAX_SERIES_ROWS


def span_for(
    df: DataFrame, keys: Sequence[str], order: str, bucket_seconds: int | None = None
) -> int:
    """The longest span of time whose densest bucket fits a task."""
    if bucket_seconds is not None:
        return bucket_seconds
    for seconds in SPANS[:-1]:
        counts = df.groupBy(*keys, bucket_of(order, seconds).alias("_bucket")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        if (counts.agg(F.max("_n")).first()[0] or 0) <= MAX_SERIES_ROWS:
            return seconds
    return SPANS[-1]


def bucketed(
    df: DataFrame, keys: Sequence[str], order: str, bucket_seconds: int | None = None
) -> DataFrame:
    """Rows with their ``_bucket``."""
    return df.withColumn(
        "_bucket", bucket_of(order, span_for(df, keys, order, bucket_seconds))
    )


def _offsets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per bucket: its row count, the rows before it, and the rows of the whole series."""
    per_bucket = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_count"))
    series = W.partitionBy(*keys)
    before = series.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return per_bucket.select(
        *keys, "_bucket", "_count",
        F.coalesce(F.sum("_count").over(before), F.lit(0).cast("long")).alias("_offset"),
        F.sum("_count").over(series).alias("_total"),
    )


def with_position(
    df: DataFrame,
    name: str = "position",
    *,
    keys: Sequence[str] = ("city",),
    order: str = "ts",
    bucket_seconds: int | None = None,
    total: str | None = None,
    split: bool | DataFrame | None = None,
) -> DataFrame:
    """Add the 0-based rank of each row in its series, and optionally the series length."""
    cut = must_split(df, keys, split)
    if not cut:
        series = W.partitionBy(*keys)
        rank = (F.row_number().over(series.orderBy(order)) - 1).cast("long")
        extra = [F.count(F.lit(1)).over(series).alias(total)] if total else []
        return df.select("*", rank.alias(name), *extra)
    rows = bucketed(df, keys, order, bucket_seconds)
    in_bucket = W.partitionBy(*keys, "_bucket").orderBy(order)
    ranked = rows.withColumn("_rank", F.row_number().over(in_bucket) - 1)
    placed = join_keys(ranked, materialize(_offsets(rows, keys)), [*keys, "_bucket"])
    extra = [F.col("_total").alias(total)] if total else []
    return placed.select(
        *df.columns, (F.col("_offset") + F.col("_rank")).alias(name), *extra
    )


def global_rank(df: DataFrame, by: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Add the 1-based place of each row in the order of ``by`` over the whole table; equal rows are in any order.

    Rows are range-partitioned, sorted and numbered within their task, and stored so that the tasks stay as they
    are. The number of rows in each task, summed up on the driver, is all that is missing.
    """
    inside = F.monotonically_increasing_id()  # the task number above 33 bits of row number
    placed = materialize(
        df.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumns({"_task": F.shiftright(inside, 33), "_row": inside.bitwiseAND(F.lit((1 << 33) - 1))}))
    counts = sorted(tuple(r) for r in placed.groupBy("_task").count().collect())  # a row per task
    before, offsets = 0, []
    for task, n in counts:
        offsets.append((task, before))
        before += n
    table = df.sparkSession.createDataFrame(offsets, "_task long, _before long")
    return placed.join(F.broadcast(table), "_task").select(
        *df.columns, (F.col("_before") + F.col("_row") + 1).alias(name))


def over_rows(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    preceding: int,
    *,
    keys: Sequence[str] = ("city",),
    order: str = "ts",
    block_rows: int = BLOCK_ROWS,
    bucket_seconds: int | None = None,
    split: bool | DataFrame | None = None,
) -> DataFrame:
    """Add row-framed window columns that reach back at most ``preceding`` rows.

    ``build`` gets the ordered window and returns the new columns. Bucket counts alone tell
    which buckets make up a block of about ``block_rows`` rows, and which earlier buckets
    hold the rows its first frames reach back to, however the series is spread over time.
    """
    if block_rows < preceding:
        raise ValueError("block_rows must be at least the number of preceding rows")
    cut = must_split(df, keys, split)
    if not cut:
        built = build(W.partitionBy(*keys).orderBy(order))
        return df.withColumns(built)
    rows = bucketed(df, keys, order, bucket_seconds)
    end = "_offset + _count"
    homes = [f"_offset DIV {block_rows}L", f"({end}) DIV {block_rows}L",
             f"({end} + {max(preceding - 1, 0)}) DIV {block_rows}L"]
    # The bucket's own block, the one starting right after it, and the last one that a row
    # of this bucket can still precede by no more than `preceding` rows.
    blocks = materialize(
        _offsets(rows, keys)
        .selectExpr(*keys, "_bucket", f"{homes[0]} AS _home",
                    f"explode(array_distinct(array({', '.join(homes)}))) AS _block")
        .selectExpr(*keys, "_bucket", "_block", "_block = _home AS _own")
    )
    window = W.partitionBy(*keys, "_block").orderBy(order)
    return _built(join_keys(rows, blocks, [*keys, "_bucket"]), df.columns, build(window))


def _built(copies: DataFrame, columns: Sequence[str], built: dict[str, Column]) -> DataFrame:
    """Evaluate window columns over all copies of the rows, then keep each row's own one."""
    kept = [c for c in columns if c not in built]
    return (
        copies.select(*kept, *[c.alias(n) for n, c in built.items()], "_own")
        .filter("_own")
        .select(*_ordered(columns, built))
    )


def _ordered(columns: Sequence[str], added: Sequence[str]) -> list[str]:
    return [*columns, *[n for n in added if n not in columns]]


def over_time(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    preceding_seconds: int,
    *,
    keys: Sequence[str] = ("city",),
    order: str = "ts",
    bucket_seconds: int | None = None,
    split: bool | DataFrame | None = None,
) -> DataFrame:
    """Add window columns framed by elapsed time, reaching back ``preceding_seconds``.

    A single shuffle either way: the copies a bucket needs from the one before it follow
    from the time alone. The window ``build`` receives is ordered by epoch microseconds.
    """
    if bucket_seconds is not None and bucket_seconds < preceding_seconds:
        raise ValueError("bucket_seconds must be at least preceding_seconds")
    cut = must_split(df, keys, split)
    rows = df.withColumn("_micros", epoch_micros(order))
    if not cut:
        built = build(W.partitionBy(*keys).orderBy("_micros"))
        return rows.withColumns(built).drop("_micros")
    span = max(span_for(df, keys, order, bucket_seconds), preceding_seconds) * 1_000_000
    home = f"floor(_micros / {span})"
    reaches_next = f"pmod(_micros, {span}L) >= {span - preceding_seconds * 1_000_000}"
    copies = rows.selectExpr(
        "*", f"{home} AS _home",
        f"explode(if({reaches_next}, array({home}, {home} + 1), array({home}))) AS _block",
    ).withColumn("_own", F.coalesce(F.expr("_block = _home"), F.lit(True)))
    # Rows that already lie together by city alone would otherwise stay there.
    copies = copies.repartition(*[F.col(k) for k in keys], F.col("_block"))
    window = W.partitionBy(*keys, "_block").orderBy("_micros")
    return _built(copies, df.columns, build(window))


def mean_over_time(
    df: DataFrame,
    means: dict[str, str],
    preceding_seconds: int,
    *,
    keys: Sequence[str] = ("city",),
    order: str = "ts",
    bucket_seconds: int | None = None,
    split: bool | DataFrame | None = None,
) -> DataFrame:
    """Add means (new column: column) of the known values of the last ``preceding_seconds``, ends included.

    A sliding frame is summed anew for every row, so dense series cost the square of their rows. Here time is cut
    into blocks as long as the frame: a frame is what its own block holds up to the row and the end of the block
    before, and both are running sums. A row enters the next block once more at the time that it leaves the frames,
    so one shuffle does. No sum is taken back from another, and NaN and infinities stay in their frames.

    Every series is cut into these blocks, however short it is, so ``split`` needs no measuring. Rows without a time
    are a block of their own.
    """
    if bucket_seconds is not None and bucket_seconds < preceding_seconds:
        raise ValueError("bucket_seconds must be at least preceding_seconds")
    if preceding_seconds <= 0:  # a frame of one instant is summed once
        return over_time(
            df, lambda w: {n: F.avg(c).over(w.rangeBetween(0, 0)) for n, c in means.items()}, 0,
            keys=keys, order=order, bucket_seconds=bucket_seconds, split=split)
    reach = preceding_seconds * 1_000_000
    rows = df.withColumn("_micros", epoch_micros(order))
    home = F.expr(f"(_micros - pmod(_micros, {reach}L)) DIV {reach}L")
    own = F.struct(home.alias("_block"), F.col("_micros").alias("_at"), F.lit(True).alias("_own"))
    later = F.struct((home + 1).alias("_block"), (F.col("_micros") + reach).alias("_at"), F.lit(False).alias("_own"))
    both = F.when(F.col("_micros").isNull(), F.array(own)).otherwise(F.array(own, later))
    needed = {*keys, *means.values()}
    copies = rows.withColumn("_copy", F.explode(both)).select(
        *[c if c in needed else F.when(F.col("_copy._own"), F.col(c)).alias(c) for c in df.columns], "_copy.*")
    block = W.partitionBy(*keys, "_block")
    past = block.orderBy("_at").rangeBetween(W.unboundedPreceding, 0)
    left = block.orderBy(F.desc("_at")).rangeBetween(W.unboundedPreceding, 0)

    def mean(c: str) -> Column:
        kind = df.schema[c].dataType
        value = F.col(c).cast("double") if isinstance(kind, T.NumericType) and not isinstance(kind, T.DecimalType) else F.col(c)
        mine, before = F.when(F.col("_own"), value), F.when(~F.col("_own"), value)
        sums = F.sum(mine).over(past), F.sum(before).over(left)
        n = F.count(mine).over(past) + F.count(before).over(left)
        return F.try_divide(F.coalesce(sums[0] + sums[1], *sums), n).cast(df.select(F.avg(c)).schema[0].dataType)

    return _built(copies, df.columns, {n: mean(c) for n, c in means.items()})


def bucket_edges(
    rows: DataFrame, columns: Sequence[str], keys: Sequence[str], order: str
) -> DataFrame:
    """Values that cross bucket edges, one row per bucket.

    ``_prev_x`` is the last known x before the bucket, ``_next_x`` the first one after it,
    ``_head_x`` the first one of the series.
    """
    aggs = []
    for c in columns:
        known = F.when(F.col(c).isNotNull(), F.col(order))
        aggs += [F.max_by(c, known).alias(f"_last_{c}"), F.min_by(c, known).alias(f"_first_{c}")]
    per_bucket = rows.groupBy(*keys, "_bucket").agg(*aggs)
    series = W.partitionBy(*keys)
    so_far = series.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    to_come = series.orderBy(F.desc("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    whole = series.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    carried = []
    for c in columns:
        carried += [
            F.last(f"_last_{c}", ignorenulls=True).over(so_far).alias(f"_prev_{c}"),
            F.last(f"_first_{c}", ignorenulls=True).over(to_come).alias(f"_next_{c}"),
            F.first(f"_first_{c}", ignorenulls=True).over(whole).alias(f"_head_{c}"),
        ]
    return per_bucket.select(*keys, "_bucket", *carried)


def fill(
    df: DataFrame,
    columns: Sequence[str],
    how: str,
    *,
    keys: Sequence[str] = ("city",),
    order: str = "ts",
    bucket_seconds: int | None = None,
    split: bool | DataFrame | None = None,
) -> DataFrame:
    """Replace NULLs by neighbouring values of the series, however far away.

    ``how`` is ``forward``, ``backward`` or ``both`` (forward, then backward for the rest).
    """
    if how not in ("forward", "backward", "both"):
        raise ValueError(f"unknown direction {how!r}")
    cut = must_split(df, keys, split)
    if cut:
        rows = bucketed(df, keys, order, bucket_seconds)
        edges = materialize(bucket_edges(rows, columns, keys, order))
        rows = join_keys(rows, edges, [*keys, "_bucket"])
        span = W.partitionBy(*keys, "_bucket")
    else:
        rows, span = df, W.partitionBy(*keys)
    past = span.orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    future = span.orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, 0)
    whole = span.orderBy(order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)

    def filled(c: str) -> Column:
        if how == "backward":
            near = [F.last(c, ignorenulls=True).over(future)]
            far = [f"_next_{c}"]
        else:
            near = [F.last(c, ignorenulls=True).over(past)]
            far = [f"_prev_{c}"]
        if how == "both":
            # What the forward fill leaves open precedes the first known value.
            near += [] if cut else [F.first(c, ignorenulls=True).over(whole)]
            far += [f"_head_{c}"]
        return F.coalesce(*near, *[F.col(x) for x in far if cut])

    wanted = set(columns)
    return rows.select(*[filled(c).alias(c) if c in wanted else c for c in df.columns])


def rank_cuts(
    df: DataFrame,
    ranks: Callable[[Column], dict[str, Column]],
    *,
    keys: Sequence[str] = ("city",),
    order: str = "ts",
    bucket_seconds: int | None = None,
    split: bool | DataFrame | None = None,
) -> DataFrame:
    """Per series, the ``order`` value found at given 0-based ranks.

    ``ranks`` maps the series length to named ranks. Only the key columns are shuffled. If
    some series is too long for one task, bucket counts tell which bucket holds each rank
    and only those buckets are sorted.
    """
    rows = df.select(*keys, order)
    cut = must_split(rows, keys, split)
    if not cut:
        series = W.partitionBy(*keys)
        ranked = rows.select(
            *keys, order, (F.row_number().over(series.orderBy(order)) - 1).alias("_rank"),
            F.count(F.lit(1)).over(series).alias("_total"),
        )
        return ranked.groupBy(*keys).agg(*[
            F.max(F.when(F.col("_rank") == r, F.col(order))).alias(n)
            for n, r in ranks(F.col("_total")).items()
        ])
    rows = bucketed(rows, keys, order, bucket_seconds)
    offsets = _offsets(rows, keys)
    named = ranks(F.col("_total"))
    targets = F.array(*[
        F.struct(F.lit(n).alias("name"), r.cast("long").alias("rank")) for n, r in named.items()
    ])
    wanted = materialize(
        offsets.select(*keys, "_bucket", "_offset", "_count", F.explode(targets).alias("_t"))
        .filter("_t.rank >= _offset AND _t.rank < _offset + _count")
        .select(*keys, "_bucket", F.col("_t.name").alias("_name"),
                (F.col("_t.rank") - F.col("_offset")).alias("_local"))
    )
    in_bucket = W.partitionBy(*keys, "_bucket", "_name").orderBy(order)
    hits = (
        join_keys(rows, wanted, [*keys, "_bucket"])
        .withColumn("_rank", F.row_number().over(in_bucket) - 1)
        .filter("_rank = _local")
    )
    return hits.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == n, F.col(order))).alias(n) for n in named]
    )
