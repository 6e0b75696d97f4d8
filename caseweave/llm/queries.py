"""The registered queries of the operators, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_pairs, chat, fingerprints, hard_negatives, langid, line_runs, minhash, packing, secret_scan, token_counts, topk,
    toxicity, vectors, whitening,
)
from .sql import SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(parts: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts))


def op1_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)
    found = topk.top_k(vectors, F.col("id") % 20 == 0, 20)
    return found.select("query_id", "rank", "vec_id", "score")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(remainder(5) != 0))
    found = langid.predict(docs, model)
    return found.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def op3_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in secret_scan.BASE),
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.with_next(_table(spark, sf_dir, "documents"))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    rows = rows.select(
        "*",
        *(fingerprints.sketch(F.col(c)).alias(f"kept_{k}") for k, c in
          (("own", "text"), ("edited", "edited"), ("next", "next_text"))),
    )
    kept = lambda k: F.col(f"kept_{k}")
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.fingerprint(F.col("text"), kept("own")).alias("fingerprint"),
        fingerprints.fingerprint(F.col("edited"), kept("edited")).alias("edited_fingerprint"),
        fingerprints.likeness(kept("own"), kept("edited"), F.col("text") == F.col("edited")).alias("near_edited"),
        fingerprints.likeness(kept("own"), kept("next"), F.col("text") == F.col("next_text")).alias("near_next"),
    )


def op5_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = _tokenizer("byte_bpe_50k.tiktoken")
    encoded = byte_pairs.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = byte_pairs.decode(encoded, ranks)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], turns.schema)
    turns = turns.unionByName(more).withColumn("parts", chat.text_part(F.col("text")))
    chats = chat.format_chats(turns)
    turn = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    told = F.array_join(F.transform(chat.read_turns(F.col("formatted")), turn), "")
    loss = chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    return chats.select(
        "conv_id",
        F.size(chat.read_turns(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").filter(remainder(4) != 2)
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.count_tokens(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, model, error = whitening.whitened_rows(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1024, 100_000)
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values)).cast("array<double>")
    every = found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return every.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").filter("vec_id is not null and label is not null")
    rows = vectors.whole(rows.select("vec_id", moved.alias("label"), "embedding"), "embedding", 256)
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), "label", "x")
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_segment_topk, op2_language_id, op3_secret_links, op4_fingerprints, op5_retrieval_packing,
        op6_minhash_dedup, op7_byte_bpe, op8_chat_format, op9_toxicity, op10_token_counts, op11_line_dedup, op12_whitening,
        op13_hard_negatives,
    )
}
