"""Event projection for viewers: only allow-listed fields of known event types leave the system.

Plain column expressions, the same in batch and in a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.spans import once

ERR = vocab.TYPE_ERROR


def event_type_of(body: Column) -> Column:
    """Event type across log dialects; an empty value falls through like a missing one."""
    pick = lambda n: F.nullif(F.get_json_object(body, f"$.{n}"), F.lit(""))
    return F.coalesce(pick("event_type"), pick("event"), pick("template_id"))


def event_ts_of(body: Column) -> Column:
    pick = lambda n: F.nullif(F.get_json_object(body, f"$.{n}"), F.lit(""))
    return F.coalesce(pick("ts"), pick("timestamp"))


def scrub(field: Column, shape: str, arg, written: Column | None = None) -> Column:
    """A variant field as text if it has the declared shape, else `<typeerror>`; null when absent.

    `written` is the value as it stands in the payload: 60.0 stays 60.0.
    """
    kind, value = F.schema_of_variant(field), field.try_cast("string")
    whole = kind == "BIGINT"
    if shape == "enum":
        fits = (kind == "STRING") & value.isin(*arg)
    elif shape == "int":
        fits = whole & field.try_cast("bigint").between(*arg)
    elif shape == "num":
        number = whole | F.startswith(kind, F.lit("DECIMAL")) | kind.isin("DOUBLE", "FLOAT")
        fits = number & F.when(number, field.try_cast("double")).between(*arg)
    elif shape == "iso8601":
        fits = (kind == "STRING") & F.rlike(value, F.lit(vocab.ISO8601))
    else:
        raise ValueError(f"unknown shape {shape!r}")
    shown = value if written is None else written
    return F.when(field.isNotNull(), F.when(F.coalesce(fits, F.lit(False)), shown).otherwise(ERR))


# a field has one shape wherever it appears, so each is scrubbed once per event
FIELDS = {name: rule for fields in vocab.EVENT_FIELDS.values() for name, rule in fields.items()}


def _summary(event_type: Column) -> Column:
    out = F
    for name, template in vocab.EVENT_SUMMARIES.items():
        parts, rest = [], template
        while "{" in rest:
            lead, _, rest = rest.partition("{")
            field, _, rest = rest.partition("}")
            parts += [F.lit(lead), F.coalesce(F.col(f"s_{field}"), F.lit(ERR))]
        out = out.when(event_type == name, F.concat(*parts, F.lit(rest)))
    return out.otherwise(vocab.SUMMARY_UNKNOWN)


def project(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Projected events from (source, ts, event_type, payload).

    An unknown type yields kind, ts, source and the fixed summary and nothing else. A payload
    that is not an object counts as empty. Columns in `keep` are passed through for the caller.
    """
    kind = F.col("event_type")
    known = F.coalesce(kind.isin(*vocab.EVENT_FIELDS), F.lit(False))
    is_object = F.startswith(F.ltrim("payload"), F.lit("{"))
    rows = events.withColumn("b_", once(F.when(known & is_object, F.try_parse_json("payload"))))
    users = {f: [t for t, fields in vocab.EVENT_FIELDS.items() if f in fields] for f in FIELDS}
    field = lambda f: F.try_variant_get("b_", f"$.{f}", "variant")
    written = {f: F.get_json_object("payload", f"$.{f}") for f, (shape, _) in FIELDS.items() if shape == "num"}
    scrubbed = {
        f"s_{f}": once(F.when(kind.isin(*users[f]), scrub(field(f), *FIELDS[f], written.get(f))))
        for f in FIELDS
        if f != "ts"
    }
    severity = F.coalesce(scrub(field("severity"), "enum", vocab.SEVERITIES), F.lit("info"))
    rows = rows.withColumns(scrubbed)
    ts = F.when(F.coalesce(F.rlike("ts", F.lit(vocab.ISO8601)), F.lit(False)), F.col("ts")).otherwise(ERR)
    return rows.select(
        *(keep or []),
        F.lit("event").alias("kind"),
        ts.alias("ts"),
        F.coalesce("source", F.lit("unknown")).alias("source"),
        F.when(known, kind).alias("event_type"),
        F.col("s_stage").alias("stage"),
        F.when(known, severity).alias("severity"),
        F.when(known, _summary(kind)).otherwise(vocab.SUMMARY_UNKNOWN).alias("summary"),
    )
