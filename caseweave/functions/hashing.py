"""Digest expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT, RECORD = "\x1f", "\x1e"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def params_digest(*parts: Column) -> Column:
    """Digest of several parameters in a fixed order, absent ones as empty text."""
    return digest(F.concat_ws(UNIT, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def pairs_digest(pairs: Column) -> Column:
    """Digest of an array of struct(label, digest), whatever order they come in."""
    lines = F.transform(
        F.array_sort(pairs),
        lambda p: F.concat(p["label"], F.lit(UNIT), p["digest"], F.lit(RECORD)),
    )
    return digest(F.array_join(lines, ""))


def json_digest(**fields: Column) -> Column:
    """Digest of compact JSON with keys in alphabetical order."""
    body = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))
    return digest(body)


def cluster_id(name: Column) -> Column:
    """Sixteen hex characters that name a cluster, from its canonical name."""
    return F.substring(F.sha1(F.coalesce(name, F.lit("")).cast("binary")), 1, 16)


def uuid5(namespace: Column, name: Column) -> Column:
    """Name-based UUID (version 5) in a namespace given as UUID text."""
    raw = F.sha1(F.concat(F.unhex(F.replace(namespace, F.lit("-"), F.lit(""))), name.cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(raw, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-",
        F.substring(raw, 1, 8),
        F.substring(raw, 9, 4),
        F.concat(F.lit("5"), F.substring(raw, 14, 3)),
        F.concat(variant, F.substring(raw, 18, 3)),
        F.substring(raw, 21, 12),
    )


def correlation_id(namespace: str, case_id: Column, strategy: Column, ref: Column) -> Column:
    """Stable id of a (strategy, document) pair inside a case."""
    return uuid5(uuid5(F.lit(namespace), case_id), F.concat(strategy, F.lit(":"), ref))


def normal_newlines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
