"""Turning a model's reply into a row: JSON extraction, coercion to closed vocabularies, errors as data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import stats, vocab


def reply_json(reply: Column) -> Column:
    """The JSON object in a reply: inside a code fence if there is one, else first { to last }."""
    fenced = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    bare = F.regexp_extract(reply, r"(?s)\{.*\}", 0)
    return F.when(fenced != "", fenced).when(bare != "", bare)


def field(body: Column, name: str) -> Column:
    return F.get_json_object(body, f"$.{name}")


def one_of(value: Column, allowed: list[str], default: str) -> Column:
    return F.when(value.isin(*allowed), value).otherwise(F.lit(default))


def text_field(body: Column, name: str, cap: int, default: str = "") -> Column:
    return F.substring(F.coalesce(field(body, name), F.lit(default)), 1, cap)


def error_code(reply: Column, body: Column, reachable: Column) -> Column:
    """Why a reply could not be used; null when it could."""
    return (
        F.when(~reachable, "model_unreachable")
        .when(F.coalesce(F.trim(reply), F.lit("")) == "", "empty_response")
        .when(body.isNull() | F.try_parse_json(body).isNull(), "schema_validation_failed")
    )


def primary_row(reply: Column, reachable: Column) -> Column:
    """Scope verdict of a reply; unusable replies read as ambiguous."""
    body = reply_json(reply)
    error = error_code(reply, body, reachable)
    verdict = one_of(field(body, "durant_verdict"), vocab.PRIMARY_VERDICTS, "ambiguous")
    return F.struct(
        F.when(error.isNull(), verdict).otherwise("ambiguous").alias("primary_verdict"),
        F.when(error.isNull(), text_field(body, "rationale", 600)).alias("rationale"),
        error.alias("error_state"),
    )


def recheck_row(reply: Column, reachable: Column) -> Column:
    """Second opinion of a reply; unusable or unknown replies escalate, never confirm."""
    body = reply_json(reply)
    error = error_code(reply, body, reachable)
    safe = "reclassify_to_ambiguous"
    verdict = one_of(field(body, "recheck_verdict"), vocab.RECHECK_VERDICTS, safe)
    return F.struct(
        F.when(error.isNull(), verdict).otherwise(safe).alias("recheck_verdict"),
        F.when(error.isNull(), text_field(body, "rationale", 600)).alias("rationale"),
        error.alias("error_state"),
    )


def context_row(reply: Column, reachable: Column) -> Column:
    """Full context classification of a reply, every field in its closed vocabulary."""
    body = reply_json(reply)
    error = error_code(reply, body, reachable)
    good = error.isNull()
    kind = field(body, "primary_classification")
    confidence = stats.clamp01(F.coalesce(field(body, "confidence").try_cast("double"), F.lit(0.0)))
    return F.struct(
        F.when(good, one_of(field(body, "durant_verdict"), vocab.PRIMARY_VERDICTS, "ambiguous"))
        .otherwise("ambiguous").alias("primary_verdict"),
        F.when(good & kind.isNotNull(), one_of(kind, vocab.CLASSIFICATIONS, "other"))
        .otherwise("communication").alias("primary_classification"),
        F.when(good, one_of(field(body, "is_about_requester"), vocab.IS_ABOUT, "unclear"))
        .otherwise("unclear").alias("is_about_requester"),
        F.when(good, confidence).otherwise(0.0).alias("confidence"),
        F.when(good, text_field(body, "requester_role", 32, "none")).otherwise("none").alias("requester_role"),
        F.when(good, text_field(body, "evidence_snippet", 300)).otherwise("").alias("evidence_snippet"),
        F.when(good, text_field(body, "recommended_action", 32, vocab.CONTEXT_ACTION_DEFAULT))
        .otherwise(vocab.CONTEXT_ACTION_DEFAULT).alias("recommended_action"),
        F.when(good, text_field(body, "rationale", 500)).otherwise("").alias("rationale"),
        error.alias("error_state"),
    )


def leak_terms(note: Column) -> Column:
    """Terms a reviewer listed at the head of a note for another redaction round."""
    listed = F.regexp_extract(note, r"LEAK_TERMS=(\[.*?\])(?:\n|$)", 1)
    return F.when(listed != "", F.from_json(listed, "array<string>"))


def trim_error(body: Column, cap: int = 400) -> Column:
    """An error object cut down to its code and message; anything that is not an object is null."""

    def short(name: str) -> Column:
        value = field(body, name)
        return F.when(F.char_length(value) > cap, F.concat(F.substring(value, 1, cap - 1), F.lit("…"))).otherwise(value)

    is_object = F.startswith(F.ltrim(body), F.lit("{")) & F.try_parse_json(body).isNotNull()
    return F.when(is_object, F.struct(short("code").alias("code"), short("message").alias("message")))
