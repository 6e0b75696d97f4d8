"""Ordered operations over groups too large for one task.

A plain window sends a whole group to one task. Here each group is first cut into
coarse buckets whose order is known, the buckets are summarised (with partial
aggregation), and only the small per-bucket summary is walked in order. Rows are then
ranked or linked inside their own bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def hash_rank_key(seed: int | str, *columns: Column) -> Column:
    """A fixed pseudo-random sort key, the same however the data is partitioned."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]), 256)


def global_rank(
    df: DataFrame,
    keys: list[str],
    coarse: list[tuple[Column, bool]],
    fine: list[Column],
    name: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """Exact 1-based rank inside each key group without one task per group.

    `coarse` lists (expression, descending) pairs whose joint order agrees with the
    wanted order and are never null; `fine` orders rows that share a coarse bucket. With a hash prefix as
    the last coarse column, ties of any size are spread evenly.
    """
    cols = [f"_c{i}" for i in range(len(coarse))]
    # keys that cannot be null, so that one plain equi-join on the window's own partitioning will do
    own = [f"_k{i}" for i in range(len(keys))]
    df = df.withColumns(
        {k: F.coalesce(F.col(name_).cast("string"), F.lit("\x00")) for k, name_ in zip(own, keys)}
        | {c: e for c, (e, _) in zip(cols, coarse)}
    )
    buckets = df.groupBy(*own, *cols).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.desc(c) if down else F.asc(c) for c, (_, down) in zip(cols, coarse)]
    walk = Window.partitionBy(*own).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summary = buckets.withColumn("_before", F.coalesce(F.sum("_n").over(walk), F.lit(0)))
    if total:
        summary = summary.withColumn(total, F.sum("_n").over(Window.partitionBy(*own)))
    inside = Window.partitionBy(*own, *cols).orderBy(*fine)
    ranked = df.withColumn("_rn", F.row_number().over(inside))
    out = ranked.join(summary.drop("_n"), [*own, *cols], "inner")
    return out.withColumn(name, F.col("_before") + F.col("_rn")).drop(*own, *cols, "_before", "_rn")


def linked(
    df: DataFrame,
    keys: list[str],
    seq: str,
    carry: list[str],
    width: int = 100_000,
    prefix: str = "prev_",
) -> DataFrame:
    """Each row with values of the row before it in its group (a lag over any group size).

    Rows are bucketed by seq // width; inside a bucket a window gives the previous row,
    and the first row of a bucket takes the last row of the nearest earlier bucket.
    """
    bucketed = df.withColumn("_b", F.floor(F.col(seq) / F.lit(width)))
    tail = bucketed.groupBy(*keys, "_b").agg(F.max_by(F.struct(*carry), F.col(seq)).alias("_last"))
    tail = tail.withColumn("_link", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_b")))
    inside = Window.partitionBy(*keys, "_b").orderBy(seq)
    rows = bucketed.withColumn("_here", F.lag(F.struct(*carry)).over(inside))
    out = rows.join(tail.select(*keys, "_b", "_link"), [*keys, "_b"], "inner")
    prev = F.coalesce("_here", "_link")
    return out.withColumns({f"{prefix}{c}": prev[c] for c in carry}).drop("_b", "_here", "_link")


CUTS = 64  # quantiles that cut a bucket with too many values


def _narrowed(counted: DataFrame, wide: DataFrame, group: list[str], value: str) -> DataFrame:
    """The part of each wide bucket that holds the middle, found by counting between quantiles of its values."""
    held = wide.select(*group, "_low", "_high", "_before", "_lo", "_hi")
    inside = counted.join(held, group, "inner").filter(F.col(value).between(F.col("_low"), F.col("_high")))
    shares = [i / CUTS for i in range(1, CUTS)]
    cuts = inside.groupBy(*group).agg(F.percentile_approx(value, shares, 10_000).alias("_cuts"))
    part = F.size(F.filter("_cuts", lambda cut: cut < F.col(value)))
    same = [F.first(c).alias(c) for c in ("_lo", "_hi")]
    parts = inside.join(cuts, group, "inner").groupBy(*group, part.alias("_part")).agg(
        F.sum("_n").alias("_bn"),
        F.count(F.lit(1)).alias("_values"),
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
        F.first("_before").alias("_from"),
        *same,
    )
    walk = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.col("_from") + F.coalesce(F.sum("_bn").over(walk), F.lit(0)))
    parts = parts.filter((F.col("_before") < F.col("_hi")) & (F.col("_before") + F.col("_bn") >= F.col("_lo")))
    return parts.groupBy(*group).agg(
        F.min("_before").alias("_before"), F.sum("_values").alias("_values"), F.min("_low").alias("_low"),
        F.max("_high").alias("_high"), *same,
    )


def middle_values(df: DataFrame, keys: list[str], value: str, bucket: Column, most: int = 100_000) -> DataFrame:
    """Counted values around the middle of each group, at most `most` of a bucket, with the rows before them.

    `_n` rows have the value, `_before` rows lie below the bucket's first value here; `_lo` and `_hi` are the ranks
    of the middle. A bucket with more distinct values is cut at its quantiles until the part that holds the middle is
    small enough, so values crowded into one bucket still spread over tasks. Each turn is a pass over the counted
    values of the wide buckets and leaves about 1 / CUTS of them.
    """
    group = [*keys, "_b"]
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, bucket.alias("_b"), value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    counted = cut_lineage(counted)
    totals = counted.groupBy(*group).agg(
        F.sum("_n").alias("_bn"), F.count(F.lit(1)).alias("_values"), F.min(value).alias("_low"), F.max(value).alias("_high")
    )
    walk = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns(
        {
            "_before": F.coalesce(F.sum("_bn").over(walk), F.lit(0)),
            "_all": F.sum("_bn").over(Window.partitionBy(*keys)),
        }
    ).withColumns({"_lo": F.floor((F.col("_all") + 1) / 2), "_hi": F.floor(F.col("_all") / 2) + 1})
    middle = totals.filter(
        (F.col("_before") < F.col("_hi")) & (F.col("_before") + F.col("_bn") >= F.col("_lo"))
    )
    middle = cut_lineage(middle.select(*group, "_before", "_values", "_low", "_high", "_lo", "_hi"))
    most = max(most, 2 * CUTS)  # below that two neighbouring parts may not shrink
    while middle.filter(F.col("_values") > most).limit(1).count():
        wide = middle.filter(F.col("_values") > most)
        middle = cut_lineage(middle.filter(F.col("_values") <= most).unionByName(_narrowed(counted, wide, group, value)))
    near = counted.join(middle, group, "inner")
    return near.filter(F.col(value).between(F.col("_low"), F.col("_high")))


def exact_median(
    df: DataFrame, keys: list[str], value: str, bucket: Column, name: str = "median", most: int = 100_000
) -> DataFrame:
    """Exact median per group from counted values.

    `bucket` is a coarse, order-keeping function of the value (its floor, say). Values are
    counted before the shuffle, the bucket holding the middle is found from bucket totals,
    and only the distinct values around the middle are walked, at most `most` in a task. Null values do not count.
    """
    near = middle_values(df, keys, value, bucket, most)
    upto = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_end", F.col("_before") + F.sum("_n").over(upto))
    start = F.col("_end") - F.col("_n")
    return (
        near.filter((start < F.col("_hi")) & (F.col("_end") >= F.col("_lo")))
        .groupBy(*keys)
        .agg(((F.min(value) + F.max(value)) / 2).alias(name))
    )
