"""Span expressions: where patterns and needles occur in a text, and what replaces them.

Offsets count characters (code points) from zero, end exclusive. Everything here works
on one row, so no shuffle is needed between finding spans and using them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab

SPAN = "struct<start:int,end:int,text:string,type:string>"


def empty(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def unicode_pattern(pattern: str) -> str:
    """Let \\b, \\d, \\s and \\w see all of Unicode."""
    return "(?U)" + pattern


def once(value: Column) -> Column:
    """The same value, computed once per row.

    The optimizer copies an expression into every filter and column built on it. That is right for
    cheap ones; a column of spans is not. A term it must not copy (a random number) keeps it in place.
    """
    return F.when(F.abs(F.rand(0)) >= 0, value)


def let(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


CHUNK = 512


def running(values: Column) -> Column:
    """For each number of an array the sum of those before it, and at the end the sum of all.

    Chunks are summed one by one and then moved by the sums of the chunks before them: an append copies a chunk,
    never the whole array.
    """

    def sums(part: Column) -> Column:
        seed = F.struct(F.lit(0).alias("pos"), empty("int").alias("out"))
        return F.aggregate(
            part, seed, lambda acc, x: F.struct((acc["pos"] + x).alias("pos"), F.array_append(acc["out"], acc["pos"]).alias("out"))
        )

    def moved(parts: Column) -> Column:
        ends = F.transform(parts, lambda p: p["pos"])
        return let(sums(ends), lambda before: F.array_append(
            F.flatten(F.zip_with(parts, before["out"], lambda p, at: F.transform(p["out"], lambda x: x + at))), before["pos"]
        ))

    def cut(held: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor(F.size(held) / CHUNK).cast("int"))
        return F.transform(chunks, lambda k: sums(F.slice(held, k * CHUNK + 1, F.lit(CHUNK))))

    return let(values, lambda held: let(cut(held), moved))


def _walk(gaps: Column, hits: Column, kind: Column | str) -> Column:
    """Turn the pieces between hits plus the hits themselves into offset spans."""
    label = F.lit(kind) if isinstance(kind, str) else kind
    pairs = F.zip_with(
        gaps, hits, lambda gap, hit: F.struct(F.char_length(gap).alias("gap"), hit.alias("hit"))
    )

    def shaped(before: Column, pair: Column) -> Column:
        start = before + pair["gap"]
        return F.struct(
            start.alias("start"), (start + F.char_length(pair["hit"])).alias("end"), pair["hit"].alias("text"), label.alias("type")
        )

    def spans_of(held: Column) -> Column:
        widths = F.transform(held, lambda p: p["gap"] + F.coalesce(F.char_length(p["hit"]), F.lit(0)))
        # the last piece has no hit after it, and running sums have one number more than there are pieces
        whole = F.zip_with(F.slice(running(widths), F.lit(1), F.size(held) - 1), F.slice(held, F.lit(1), F.size(held) - 1), shaped)
        return F.when(F.size(held) > 1, whole).otherwise(empty(SPAN))

    return let(pairs, spans_of)


def pattern_spans(text: Column, pattern: str, kind: str, guard: Column | None = None) -> Column:
    """Every match of a regular expression with its offsets, left to right.

    `guard` is a cheap necessary condition: rows failing it skip the pattern.
    """
    rx = unicode_pattern(pattern)
    found = _walk(F.split(text, rx, -1), F.regexp_extract_all(text, F.lit(rx), F.lit(0)), kind)
    usable = text.isNotNull() if guard is None else guard
    return F.when(usable, found).otherwise(empty(SPAN))


def folded(text: Column) -> Column:
    """Lower case with unchanged length: the one letter that would grow is mapped first."""
    return F.lower(F.translate(text, "\u0130", "I"))


def needle_spans(low: Column, needle: Column, kind: Column | str) -> Column:
    """Every case-insensitive, non-overlapping occurrence of a literal needle in a folded text."""
    label = F.lit(kind) if isinstance(kind, str) else kind
    quoted = F.replace(folded(needle), F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    gaps = F.split(low, F.concat(F.lit("\\Q"), quoted, F.lit("\\E")), -1)
    width = F.char_length(needle)

    def shaped(before: Column, gap: Column) -> Column:
        start = before + F.char_length(gap)
        return F.struct(start.alias("start"), (start + width).alias("end"), needle.alias("text"), label.alias("type"))

    def spans_of(held: Column) -> Column:
        widths = F.transform(held, lambda gap: F.char_length(gap) + width)
        # the piece after the last hit adds one span too many
        return F.slice(F.zip_with(F.slice(running(widths), F.lit(1), F.size(held)), held, shaped), F.lit(1), F.size(held) - 1)

    return F.when(width > 0, let(gaps, spans_of)).otherwise(empty(SPAN))


def contact_spans(text: Column) -> Column:
    """The deterministic layer: e-mail addresses, UK phone numbers, NI numbers, in that order."""
    return F.concat(
        pattern_spans(text, vocab.EMAIL, "email", F.contains(text, F.lit("@"))),
        pattern_spans(text, vocab.PHONE_UK, "phone_uk"),
        pattern_spans(text, vocab.NINO, "nino"),
    )


def badge(classification: Column, redact: Column) -> Column:
    """Badge code of an entity: an open flag always reads as needing review."""
    codes = F.create_map(*[F.lit(x) for pair in vocab.BADGES.items() for x in pair])
    return F.when(redact == "flag", F.lit(vocab.BADGE_DEFAULT)).otherwise(
        F.coalesce(F.try_element_at(codes, F.coalesce(classification, F.lit(""))), F.lit(vocab.BADGE_DEFAULT))
    )


def redact_state(raw: Column) -> Column:
    """The mixed true / false / "flag" field as one string: redact, preserve or flag."""
    value = F.lower(F.trim(raw.cast("string")))
    return (
        F.when(value.isin("true", "redact"), "redact")
        .when(value.isin("false", "preserve"), "preserve")
        .when(value == "flag", "flag")
    )


def apply_overlay(text: Column, overlay: Column) -> Column:
    """Text with [CODE] in place of redacted and flagged spans.

    `overlay` is an array of structs (start, ord, end, redact, code). Spans are taken in
    start order (then `ord`); one that begins before the end of the last taken span, or
    does not fit the text, is passed over. Preserved spans still advance the cursor.
    """
    size = F.char_length(text)

    def step(acc: Column, span: Column) -> Column:
        fits = (
            (span["start"] >= acc["pos"])
            & (span["start"] < size)
            & (span["end"] <= size)
            & (span["end"] > span["start"])
        )
        before = F.substring(text, acc["pos"] + 1, span["start"] - acc["pos"])
        shown = F.when(
            span["redact"].isin("redact", "flag"), F.concat(F.lit("["), span["code"], F.lit("]"))
        ).otherwise(F.substring(text, span["start"] + 1, span["end"] - span["start"]))
        return F.struct(
            F.when(fits, span["end"]).otherwise(acc["pos"]).alias("pos"),
            F.when(fits, F.concat(acc["parts"], F.array(before, shown)))
            .otherwise(acc["parts"])
            .alias("parts"),
        )

    seed = F.struct(F.lit(0).alias("pos"), empty("string").alias("parts"))

    def finish(acc: Column) -> Column:
        rest = F.substring(text, acc["pos"] + 1, size)
        return F.concat(F.array_join(acc["parts"], ""), rest)

    return F.aggregate(F.array_sort(overlay), seed, step, finish)


def chosen_spans(size: Column, spans: Column, element: str) -> Column:
    """Greedy non-overlapping choice in start order from structs that begin (start, ord, end)."""

    def step(acc: Column, span: Column) -> Column:
        fits = (
            (span["start"] >= acc["pos"])
            & (span["start"] < size)
            & (span["end"] <= size)
            & (span["end"] > span["start"])
        )
        return F.struct(
            F.when(fits, span["end"]).otherwise(acc["pos"]).alias("pos"),
            F.when(fits, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"),
        )

    seed = F.struct(F.lit(0).alias("pos"), empty(element).alias("out"))
    return F.aggregate(F.array_sort(spans), seed, step, lambda acc: acc["out"])


def snippet(text: Column, start: Column, end: Column, half: int = 60) -> tuple[Column, Column]:
    """Up to `half` characters before and after a span; empty where the text is absent."""
    lead = F.greatest(start - half, F.lit(0))
    before = F.substring(text, lead + 1, start - lead)
    after = F.substring(text, end + 1, F.lit(half))
    return F.coalesce(before, F.lit("")), F.coalesce(after, F.lit(""))
