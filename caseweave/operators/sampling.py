"""Review samples: the same seed gives the same sample however the data is partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats, vocab
from .ordered import global_rank, hash_rank_key

PREFIX = 3  # hex digits of the hash that bucket a group: 4,096 buckets


def _hashed(df: DataFrame, seed: int | str) -> DataFrame:
    return df.withColumn("_h", hash_rank_key(seed, F.col("case_id"), F.col("ref")))


def _prefix() -> Column:
    return F.substring("_h", 1, PREFIX)


def top_by_hash(df: DataFrame, keys: list[str], n: int, seed: int | str, name: str = "rank") -> DataFrame:
    """n pseudo-random rows per group. `rank <= n` is limited in every map task before the shuffle."""
    order = Window.partitionBy(*keys).orderBy("_h", "ref")
    return (
        _hashed(df, seed).withColumn(name, F.row_number().over(order)).filter(F.col(name) <= n).drop("_h")
    )


def qa_sample(docs: DataFrame, size: int = 30, seed: int = 42) -> DataFrame:
    """High / medium / random review sample per case from (case_id, ref, entity_count).

    High: most entities. Medium: a slice around the median of the rest. Random: from what is
    left. A case no larger than `size` is taken whole, as random. Ties of any size are broken by
    hash, so documents without entities, usually the largest group, spread over many tasks.
    """
    per = size // 3
    ranked = global_rank(
        _hashed(docs, seed),
        ["case_id"],
        [(F.coalesce("entity_count", F.lit(0)), True), (_prefix(), False)],
        [F.col("_h"), F.col("ref")],
        total="n_docs",
    )
    rest = F.col("n_docs") - per
    mid = F.greatest(F.lit(0), F.floor(rest / 2) - per // 2)
    place = F.col("rank") - 1 - per
    bucket = (
        F.when(F.col("n_docs") <= size, "random")
        .when(F.col("rank") <= per, "high")
        .when((place >= mid) & (place < mid + per), "medium")
    )
    ranked = ranked.withColumn("bucket", bucket)
    chosen = ranked.filter("bucket is not null")
    order = Window.partitionBy("case_id").orderBy("_h", "ref")
    rest_rows = (
        ranked.filter("bucket is null")
        .withColumn("rn", F.row_number().over(order))
        .filter(F.col("rn") <= per)
        .drop("rn")
        .withColumn("bucket", F.lit("random"))
    )
    return chosen.unionByName(rest_rows).select("case_id", "ref", "bucket", "entity_count")


def calibration_sample(strata: DataFrame, seed: int | str = "cal", wants: dict | None = None) -> DataFrame:
    """Stratified sample: a fixed number per stratum and case, fewer where the stratum is small."""
    wants = wants or vocab.STRATA
    rows = strata.filter(F.col("stratum").isin(*wants))
    top = top_by_hash(rows, ["case_id", "stratum"], max(wants.values()), seed)
    return top.filter(F.col("rank") <= stats.lookup(wants, F.col("stratum")))


def walkthrough_sample(docs: DataFrame, size: int = 50, seed: int | str = 0) -> DataFrame:
    """Seeded sample of redacted or exported documents in sample order, with the pool size."""
    eligible = docs.filter("status in ('redacted', 'exported')")
    pool = eligible.groupBy("case_id").agg(F.count(F.lit(1)).alias("eligible_pool_size"))
    picked = top_by_hash(eligible.select("case_id", "ref"), ["case_id"], size, seed, "position")
    return picked.join(pool, "case_id", "inner").withColumn("position", F.col("position") - 1)


def entity_band(count: Column, edges: tuple[int, int, int] = (1, 5, 20)) -> Column:
    """Band of an entity count; the edges are a parameter, no published value exists."""
    low, mid, high = edges
    return (
        F.when(count < low, "very_low_ner").when(count < mid, "low_ner").when(count < high, "med_ner").otherwise("high_ner")
    )


def jury_sample(
    docs: DataFrame,
    min_floor: int = 0,
    seed: int | str = "jury",
    mode: str = "tiered",
    edges: tuple[int, int, int] = (1, 5, 20),
) -> DataFrame:
    """Documents for the jury by entity band and text quality, each cell at its own rate.

    docs: case_id, ref, entity_count, text_quality. A cell at rate r gives exactly
    ceil(r * n) documents, in hash order. A case that falls short of `min_floor` is topped
    up from its unselected documents. Failed extractions go to the manual queue instead.
    """
    if mode not in ("full", "tiered", "spot_check"):
        raise ValueError(f"unknown sampling mode {mode!r}")
    quality = F.coalesce("text_quality", F.lit("unknown"))
    rows = docs.withColumns({"text_quality": quality, "band": entity_band(F.col("entity_count"), edges)})
    rates = {f"{b}|{q}": r for b, q, r in vocab.JURY_RATES}
    table = stats.lookup(rates, F.concat_ws("|", "band", "text_quality"), F.lit(vocab.JURY_RATE_DEFAULT))
    rate = {"full": F.lit(1.0), "spot_check": F.lit(vocab.SPOT_CHECK_RATE), "tiered": table}[mode]
    manual = rows.filter("text_quality = 'ocr_failure'")
    jury = _hashed(rows.filter("text_quality <> 'ocr_failure'").withColumn("rate", rate), seed)
    ranked = global_rank(
        jury, ["case_id", "band", "text_quality"], [(_prefix(), False)], [F.col("_h"), F.col("ref")], total="n_cell"
    ).withColumn("selected", F.col("rank") <= F.ceil(F.round(F.col("rate") * F.col("n_cell"), 6)))
    queue = ranked.filter("selected").select("case_id", "ref", "band", "text_quality", F.lit("jury").alias("queue"))
    if min_floor > 0:
        got = ranked.groupBy("case_id").agg(F.count_if("selected").alias("n_selected"))
        short = got.filter(F.col("n_selected") < min_floor)
        order = Window.partitionBy("case_id").orderBy("_h", "ref")
        spare = (
            ranked.filter("not selected")
            .withColumn("rn", F.row_number().over(order))
            .filter(F.col("rn") <= min_floor)
            .join(short, "case_id", "inner")
            .filter(F.col("rn") <= min_floor - F.col("n_selected"))
        )
        queue = queue.unionByName(
            spare.select("case_id", "ref", "band", "text_quality", F.lit("jury_topup").alias("queue"))
        )
    return queue.unionByName(
        manual.select("case_id", "ref", "band", "text_quality", F.lit("manual").alias("queue"))
    )


def sample_progress(sample: DataFrame, decisions: DataFrame) -> DataFrame:
    """Walk-through progress per case; any decision other than approve counts as declined."""
    from .latest import latest_per_key

    last = latest_per_key(decisions, ["case_id", "ref"]).select("case_id", "ref", "decision")
    rows = sample.join(last, ["case_id", "ref"], "left")
    pending = F.col("decision").isNull()
    return rows.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("decision") == "approve").alias("approved"),
        F.count_if(~pending & (F.col("decision") != "approve")).alias("declined"),
        F.count_if(pending).alias("pending"),
        F.min(F.when(pending, F.col("position"))).alias("next_pending"),
        ((F.count(F.lit(1)) > 0) & F.bool_and(~pending & (F.col("decision") != "pending"))).alias("complete"),
    )
