"""A corpus pipeline of five stages: what each rejects, marks or merges decides what the next one gets.

Every stage works on all that its predecessor kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.llm import langid, minhash, packing, secret_scan, toxicity
from caseweave.session import cut_lineage

CERTAIN = 0.5  # posterior that a language needs
TOXIC = 0.3  # score from which a document goes
SLICE_BYTES = 1 << 20  # text that a packing task tokenises at once, beside what earlier stages leave in an executor
BATCH_BYTES = "4m"  # a batch of rows on its way to Python, where the session names no bound (Spark's own is 64 MB)
NEAR = 80  # percent of shared five-word shingles from which two documents are near copies


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(spark: SparkSession) -> None:
    """Bounds the batches that go to Python by bytes, as texts differ in length; a session's own bound stays."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is None:
        spark.conf.set(bound, BATCH_BYTES)


def _with_plain_names(stage: Stage) -> Stage:
    """The stage on documents whose further columns have plain names; Spark's Arrow functions take no dots in them."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _in_small_batches(spark)
        plain = [c if c.isidentifier() else f"__column_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*plain), sf_dir).toDF(*docs.columns)

    return run


@_with_plain_names
def _known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Null texts, texts without a letter and unclear ones go."""
    learned = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0
    model = langid.fit(docs.filter(learned))
    if not model.langs:
        return docs.limit(0)
    found = langid.predict(docs, model, carry=tuple(docs.columns), names=("__lang", "__certain"))
    known = found.filter((F.col("__lang") != langid.UNKNOWN) & (F.col("__certain") >= CERTAIN))
    return known.select(*docs.columns)


@_with_plain_names
def _not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; without labels all stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.filter(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2)
    found = toxicity.score(docs, toxicity.fit(docs, labels), carry=tuple(docs.columns), name="__toxic")
    return found.filter(F.col("__toxic") < TOXIC).select(*docs.columns)


@_with_plain_names
def _one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked as near copies (at NEAR, not at op6's 85) the one with the smallest id.

    Rows that repeat an id are documents of their own if their texts differ: one text keeps the place of the id, the
    others come after all ids. Of rows equal in id and text one stays. Rows without an id stay. Most texts are not shuffled.
    """
    own, text = F.col("doc_id").cast("long"), F.xxhash64("text")
    least = F.min(text).alias("least")
    repeated = docs.filter("doc_id is not null").groupBy(own.alias("node")).agg(least, F.max(text).alias("most"))
    repeated = cut_lineage(repeated.filter("least < most").select("node", "least"))
    rows = docs.withColumn("__node", own)
    if repeated.limit(1).count():
        rows = minhash.marked(docs, own, repeated)
        twins = rows.filter("__hit").join(repeated, own == F.col("node"), "left")
        other = F.shiftleft(F.lit(1).cast("long"), 62).bitwiseOR(F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2))
        node = F.when(text != F.col("least"), other).otherwise(own)
        rows = cut_lineage(rows.filter("not __hit").select(*docs.columns, own.alias("__node")).unionByName(
            twins.select(*docs.columns, node.alias("__node"))
        ))
    found = cut_lineage(minhash.near_duplicates(rows, id_col="__node", percent=NEAR).filter("__node is not null"))
    gone = found.filter("not kept").select("__node").distinct()
    equal = found.groupBy("__node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__node")
    touched = gone.union(equal).select(F.col("__node").alias("node"))
    rows = minhash.marked(rows, F.col("__node"), touched)
    settled = rows.filter("not __hit").select(*docs.columns)
    kept = rows.filter("__hit").join(gone, "__node", "left_anti")
    alone = kept.join(equal, "__node", "left_anti").select(*docs.columns)
    whole = F.struct(*docs.columns)
    once = kept.join(equal, "__node", "left_semi").groupBy("__node").agg(F.min_by(whole, F.to_json(whole)).alias("row"))
    return settled.unionByName(alone).unionByName(once.select("row.*"))


@_with_plain_names
def _without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by their kind; n_chars counts the new text."""
    found = secret_scan.redacted(docs.withColumn("__old", F.char_length("text")))
    now = F.char_length("text")
    changed = F.when(now == F.col("__old"), F.col("n_chars")).otherwise(now).cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", changed).select(*docs.columns)


def _packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    import public_tokenizers

    _in_small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), slice_bytes=SLICE_BYTES)


STAGES = [
    ("language", _known_language),
    ("toxicity", _not_toxic),
    ("near_copies", _one_of_each),
    ("secrets", _without_secrets),
    ("packing", _packed),
]

#: Naive Bayes, the label model and the tokenizer have no SQL; tests/llm compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
