"""Document fingerprints: every shingle hash below a fixed fraction of the range is kept.

The fraction is the same for all texts, so sketches of very unequal documents can be compared and merged: the
share of one sketch that another holds estimates how much of the text the other contains.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
HEX_DIGITS = 12  # of a shingle's md5
KEPT = "4"  # hashes that sort below this are kept: 4 / 16 of the range
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"[\x20\x09-\x0D]+"


def _let(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(text: Column) -> Column:
    """First hex digits of the md5 of every five words in a row; fewer words are one shingle; no word, none."""
    low = F.translate(text, _CAPITALS, _SMALL)

    def of(words: Column) -> Column:
        n = F.size(words)
        last = F.greatest(n - (SHINGLE - 1), F.lit(1))
        every = F.transform(
            F.sequence(F.lit(1), last),
            lambda i: F.substring(F.md5(F.array_join(F.slice(words, i, SHINGLE), " ").cast("binary")), 1, HEX_DIGITS),
        )
        return F.when(n > 0, every).otherwise(F.expr("cast(array() as array<string>)"))

    return _let(F.filter(F.split(low, BLANKS), lambda w: w != ""), of)


def sketch(text: Column) -> Column:
    """The kept hashes, distinct and ascending."""
    return F.array_sort(F.array_distinct(F.filter(shingle_hashes(text), lambda h: h < KEPT)))


def fingerprint(text: Column, kept: Column) -> Column:
    """md5 of the text and its kept hashes as one string. Equal texts have equal fingerprints."""
    return F.concat_ws(":", F.md5(text.cast("binary")), F.array_join(kept, ""))


def likeness(a: Column, b: Column, same: Column) -> Column:
    """Estimated Jaccard similarity of two texts from their kept hashes; 1 for equal texts, 0 if neither has a hash."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(same, 1.0).when(union > 0, common / union).otherwise(0.0)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second holds; null if the first kept none."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text and the text of the next document in descending id, after the last one that of the first.

    Rows that share an id are ordered by text; null ids come last. Ids are cut into ranges of about equal
    numbers of rows (by quantiles), each range is one window, and the first row of each range also stands at the
    end of the range before. No task sees all ids. Ids must be integers.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(rows.select("id").approxQuantile("id", [k / n for k in range(1, n)], 0.25 / n)))
    width = max(1, math.isqrt(len(cuts)))
    coarse = [cuts[k] for k in range(0, len(cuts), width)]
    groups = [cuts[k + 1 : k + width] for k in range(0, len(cuts), width)]

    def numbers(values: list[float]) -> Column:
        return F.array(*(F.lit(int(v)) for v in values)).cast("array<bigint>")

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda v: v <= F.col("id")))

    # the range of an id: first among every width-th cut, then among those behind it
    high = below(numbers(coarse))
    fine = F.when(high > 0, below(F.element_at(F.array(*map(numbers, groups)), high))) if groups else F.lit(0)
    place = F.coalesce(F.when(high > 0, (high - 1) * width + fine + 1), F.lit(0)) if groups else F.lit(0)
    rows = rows.withColumn("part", place.cast("int"))
    # one row a range: a bounded number, whatever the size of the table
    tops = {r["part"]: r["top"] for r in rows.groupBy("part").agg(F.max("id").alias("top")).collect()}
    parts = sorted(tops)
    ghosts = F.array(F.col("part"))
    if parts:
        upper = dict(zip(parts, [*parts[1:], parts[0]], strict=True))
        flat = [F.lit(x) for p in parts for x in (p, upper[p])]
        heads = [F.lit(x) for p in parts for x in (p, tops[p])]
        is_top = F.col("id").eqNullSafe(F.create_map(*heads)[F.col("part")])
        ghosts = F.when(is_top, F.array(F.col("part"), F.create_map(*flat)[F.col("part")])).otherwise(ghosts)
    spread = rows.select("id", "text", F.posexplode(ghosts).alias("ghost", "at"))
    order = Window.partitionBy("at").orderBy("ghost", F.desc_nulls_last("id"), "text")
    return spread.withColumn("next_text", F.lead("text").over(order)).filter("ghost = 0").select("id", "text", "next_text")
