"""Seeded synthetic case: a fixed mix of document categories with truth labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats, vocab
from ..operators.ordered import hash_rank_key


def category_plan(doc_count: int) -> list[tuple[str, str, int]]:
    """(category, truth class, documents) for a case of the given size; always adds up to it."""
    left, plan = doc_count, []
    for category, share, truth in vocab.DOC_MIX:
        n = share if doc_count == 100 else max(1, round(share * doc_count / 100))
        n = min(n, left)
        plan.append((category, truth, n))
        left -= n
    plan.append((*vocab.DOC_PAD, left))
    return [p for p in plan if p[2] > 0]


def synthesize_case(spark: SparkSession, case_id: str, doc_count: int = 100, seed: int = 0) -> DataFrame:
    """case_id, ref, category, truth_class, filename, text. The same seed gives the same corpus.

    Which document gets which category is a seeded permutation of the ordinals: the hash of the
    ordinal is ranked in buckets, so no size is too large.
    """
    from ..operators.ordered import global_rank

    base = spark.range(1, doc_count + 1).select(F.lit(case_id).alias("case_id"), F.col("id"))
    h = hash_rank_key(seed, F.col("case_id"), F.col("id"))
    ranked = global_rank(base.withColumn("h", h), ["case_id"], [(F.substring("h", 1, 3), False)], [F.col("h"), F.col("id")])
    upto, category, truth = 0, F, F
    for name, label, n in category_plan(doc_count):
        upto += n
        category = category.when(F.col("rank") <= upto, name)
        truth = truth.when(F.col("rank") <= upto, label)
    ref = F.concat_ws("-", "case_id", F.lpad(F.col("id").cast("string"), len(str(max(doc_count, 1000))), "0"))
    rows = ranked.select("case_id", ref.alias("ref"), category.alias("category"), truth.alias("truth_class"), "h")
    subject = {"gold": "Reference: Sample Person", "mid": "cc: Sample Person", "decoy": "Reference: Another Person"}
    opening = stats.lookup(subject, F.col("truth_class"), F.lit("General notice"))
    text = F.concat_ws("\n", opening, F.concat(F.lit("Subject: "), F.col("category")), F.concat(F.lit("Item "), F.substring("h", 1, 12)))
    return rows.select(
        "case_id", "ref", "category", "truth_class", F.concat(F.lit("source/"), "ref", F.lit(".txt")).alias("filename"), text.alias("text")
    )
