"""Text expressions: word counts, truncation, cleaning, scrubbing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import vocab
from .spans import let, pattern_spans


def word_count(text: Column) -> Column:
    """Words as split on any Unicode white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\S+")), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def head_cap(text: Column, cap: int) -> tuple[Column, Column]:
    """First `cap` characters and the note that says so, empty when nothing was cut."""
    size = F.char_length(text)
    note = F.when(size > cap, F.format_string(f"\n[truncated from %d to {cap} chars]", size))
    return F.substring(text, 1, cap), F.coalesce(note, F.lit(""))


def head_tail(text: Column, cap: int, head_ratio: float = 0.75) -> Column:
    """Keep head and tail so that text plus marker is exactly `cap` characters long.

    The marker holds the number of elided characters, whose digit count moves the cut.
    The count only grows and settles within a few steps, so it is unrolled.
    Returns struct(text, mode, elided_start, elided_end).
    """
    if not 0.5 <= head_ratio <= 0.95:
        raise ValueError(f"head_ratio out of range: {head_ratio}")
    frame = len(vocab.ELIDED % "")
    if cap - frame - 12 < 200:
        raise ValueError(f"cap {cap} is too small for head, tail and marker")
    size = F.char_length(text)

    def elided_for(digits: Column) -> Column:
        return F.greatest(F.lit(0), size - (F.lit(cap - frame) - digits))

    digits = F.lit(1)
    for _ in range(4):
        digits = F.char_length(elided_for(digits).cast("string"))
    avail = F.lit(cap - frame) - digits
    head = F.floor(avail * F.lit(head_ratio)).cast("int")
    tail = avail - head
    before, after = vocab.ELIDED.split("%s")
    body = F.concat(
        F.substring(text, F.lit(1), head),
        F.lit(before),
        elided_for(digits).cast("string"),
        F.lit(after),
        F.substring(text, size - tail + 1, tail),
    )
    cut = F.struct(
        body.alias("text"),
        F.lit("head_tail").alias("mode"),
        head.alias("elided_start"),
        (size - tail).alias("elided_end"),
    )
    whole = F.struct(
        text.alias("text"), F.lit("none").alias("mode"), size.alias("elided_start"), size.alias("elided_end")
    )
    return F.when(size <= cap, whole).otherwise(cut)


def _separators() -> str:
    return "(?imud)" + "|".join(f"(?:{p})" for p in vocab.THREAD_SEPARATORS)


def thread_cut(text: Column, cap: int, head_ratio: float = 0.75) -> Column:
    """Keep the first and the last message of a mail thread; else cut head and tail."""
    size = F.char_length(text)
    found = F.transform(pattern_spans(text, _separators(), "separator", size > cap), lambda s: s["start"])
    has_subject = F.rlike(text, F.lit("(?imud)" + vocab.SUBJECT_HEADER))

    def boundaries(found: Column) -> Column:
        """Where messages after the first begin; a blank lead belongs to the message after it."""
        inner = F.filter(found, lambda s: s > 0)
        blank = strip(F.substring(text, F.lit(1), F.try_element_at(inner, F.lit(1)))) == ""
        inner = F.when(blank, F.slice(inner, 2, F.greatest(F.size(inner) - 1, F.lit(0)))).otherwise(inner)
        is_thread = (F.size(found) >= 2) | ((F.size(found) == 1) & has_subject)
        return F.when(is_thread, F.struct(F.array_min(inner).alias("end"), F.array_max(inner).alias("begin")))

    before, after = vocab.ELIDED_THREAD.split("%s")

    def joined(at: Column) -> Column:
        body = F.concat(
            F.regexp_replace(F.substring(text, F.lit(1), at["end"]), r"(?U)\s+$", ""),
            F.lit(before),
            (at["begin"] - at["end"]).cast("string"),
            F.lit(after),
            F.regexp_replace(F.substring(text, at["begin"] + 1, size), r"(?U)^\s+", ""),
        )
        return F.when(
            at["begin"] > at["end"],
            F.struct(
                body.alias("text"),
                F.lit("structure_aware_email_2msg").alias("mode"),
                at["end"].alias("elided_start"),
                at["begin"].alias("elided_end"),
            ),
        )

    cut = let(let(found, boundaries), joined)
    kept = let(cut, lambda c: F.when(F.char_length(c["text"]) <= cap, c))
    return F.coalesce(F.when(size > cap, kept), head_tail(text, cap, head_ratio))


def elided_mentions(text: Column, start: Column, end: Column, identifiers: Column) -> Column:
    """How often the subject is named in the part that was cut; short identifiers are ignored."""
    middle = F.lower(F.substring(text, start + 1, end - start))
    names = F.filter(
        F.transform(identifiers, lambda x: strip(F.lower(F.coalesce(x, F.lit(""))))),
        lambda x: F.char_length(x) >= 3,
    )
    counts = F.transform(
        names,
        lambda n: (
            (F.char_length(middle) - F.char_length(F.replace(middle, n, F.lit("")))) / F.char_length(n)
        ).cast("int"),
    )
    return F.aggregate(counts, F.lit(0), lambda a, b: a + b)


def scrub_credentials(raw: Column) -> Column:
    """Raw model text without credentials: capped before, for safety, and after, for size."""
    out = F.substring(raw, 1, vocab.RAW_INPUT_CAP)
    for pattern in vocab.CREDENTIALS:
        out = F.regexp_replace(out, pattern, vocab.CREDENTIAL_MARK.replace("[", "\\[").replace("]", "\\]"))
    return F.substring(out, 1, vocab.RAW_OUTPUT_CAP)


def hide_emails(text: Column) -> Column:
    return F.regexp_replace(text, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<email-redacted>")


def short_path(path: Column) -> Column:
    """Only the parent folder and the file name of a path."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.when(F.size(parts) == 0, path).otherwise(
        F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), "/")
    )


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def extension(path: Column) -> Column:
    """Lower-cased suffix with its dot; a leading dot alone is not a suffix."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+?(\.[^.]+)$", 1))


@F.pandas_udf(StringType())
def nfkc(values: pd.Series) -> pd.Series:
    import unicodedata

    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def clean_role(raw: Column, normalised: Column, cap: int) -> Column:
    """Free-text role field made safe: struct(value, error). `normalised` is the NFKC form of `raw`."""
    line = F.regexp_replace(normalised, r"(?U)[^\S\t]+", " ")
    visible = F.regexp_replace(
        line, r"[\p{Cc}\p{Cs}\p{Co}\p{Cn}\p{Cf}&&[^\t\u200C\u200D]]", ""
    )
    value = strip(visible)
    injected = F.lit(False)
    for pattern in vocab.INJECTIONS:
        injected = injected | F.rlike(value, F.lit("(?U)" + pattern))
    error = (
        F.when(F.char_length(raw) > vocab.ROLE_RAW_CAP, "raw_too_long")
        .when(F.char_length(value) > cap, "too_long")
        .when(injected, "injection")
    )
    return F.struct(
        F.when(error.isNull() & (value != ""), value).alias("value"), error.alias("error")
    )
