"""Secrets in texts, with weak candidates linked to the parts that complete them.

Strong patterns are reported as they are. A weak candidate (a user or client name, an opaque token, an endpoint)
is reported only if a complementary part lies in the same scope: an identifier with a secret, a secret with an
identifier or an endpoint, an endpoint with both. A part completes only candidates that it does not overlap. Scopes end
at blank lines; within one, distance does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .minhash import marked


def either_case(word: str) -> str:
    """A pattern for an ASCII word in either case that other letters never match."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The base patterns, in the order in which kinds are listed, and the group that is long enough.
ASSIGN = (
    "(" + "|".join(either_case(w) for w in ("password", "passwd", "secret", "token")) + "|"
    + either_case("api") + "_?" + either_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"  # the runs of [0-9a-f]+ that are long enough
#: kind: pattern, group and least length of it
BASE = {"assign": (ASSIGN, 2, 6), "access": (ACCESS, 0, 20), "hex": (HEX, 0, 24)}
CLIENT = (
    "(" + "|".join(either_case(w) for w in ("user", "username", "login", "account", "client_id", "key_id"))
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]+)"""
)
ENDPOINT = r"[a-z][a-z0-9+]*://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+"
OPAQUE = "[A-Za-z0-9+/_-]{16,}"
WEAK = {"client": (CLIENT, 2, 3), "endpoint": (ENDPOINT, 0, 10), "opaque": (OPAQUE, 0, 16)}
KINDS = [*BASE, *WEAK]
SCOPE_END = r"\n[\x20\t]*\n"


def _cut(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """For each match in order: kind, place, length of the gap before it, its length, and does it count."""
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("own"),
    )

    def piece(x: Column, i: Column) -> Column:
        counts = F.char_length(x["own"]) >= least
        if kind == "opaque":
            counts = counts & x["own"].rlike("[0-9]") & x["own"].rlike("[A-Z]") & x["own"].rlike("[a-z]")
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.char_length(x["gap"]).alias("gap"),
            F.coalesce(F.char_length(x["hit"]), F.lit(0)).alias("hit"),
            F.coalesce(counts, F.lit(False)).alias("counts"),
        )

    return F.transform(zipped, piece)


def _around(placed: DataFrame, key: list[str], sought: dict[str, Column]) -> DataFrame:
    """The rows with last_x, the greatest end up to their start, and next_x, the least start from their end on.

    Parts that overlap the row do not count, so both ends of all rows are walked in order of place.
    """
    at = F.inline(F.array(F.struct(F.col("end").alias("at"), F.lit(0).alias("opens")),
                          F.struct(F.col("start").alias("at"), F.lit(1).alias("opens"))))
    ends = placed.select("*", at)
    up = Window.partitionBy(*key).orderBy("at", "opens").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*key).orderBy(F.desc("at"), F.desc("opens")).rowsBetween(Window.unboundedPreceding, -1)
    last = {f"last_{k}": F.max(F.when(c & (F.col("opens") == 0), F.col("end"))).over(up) for k, c in sought.items()}
    following = {f"next_{k}": F.min(F.when(c & (F.col("opens") == 1), F.col("start"))).over(down) for k, c in sought.items()}
    walked = ends.withColumns(last | following)
    return walked.groupBy(*placed.columns).agg(
        *(F.max(F.when(F.col("opens") == 1, F.col(c))).alias(c) for c in last),
        *(F.max(F.when(F.col("opens") == 0, F.col(c))).alias(c) for c in following),
    )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: id_col, text_hash and spans, an array of (kind, start, end), in order of start
    and kind (as listed in KINDS). Code points, end exclusive.

    Null and empty texts have no spans. Rows equal in id and text have equal results, as often as they occur; a
    null id is an id like any other. An empty table gives an empty one; other columns are not read.
    Texts are not shuffled, only the lengths of matches and gaps; everything is linear in their number.

    A part completes only candidates that it does not overlap. An opaque run inside an endpoint is no secret for
    others and needs an identifier or a secret elsewhere.
    """
    text = F.coalesce(text_col, F.lit(""))
    none = "cast(array() as array<struct<kind:string,i:int,gap:int,hit:int,counts:boolean>>)"
    mark = F.array(
        F.struct(F.lit("").alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit(0).alias("hit"),
                 F.lit(False).alias("counts"))
    )

    def cut(kind: str, pattern: str, group: int, least: int) -> Column:
        # a pattern is first asked whether it occurs at all
        return F.when(F.col("t").rlike(pattern), _cut(F.col("t"), kind, pattern, group, least)).otherwise(
            F.expr(none)
        )

    rows = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    pieces = F.concat(
        mark, *(cut(kind, *how) for kind, how in (BASE | WEAK).items()), cut("|", SCOPE_END, 0, 1)
    )
    found = rows.select("id", F.xxhash64("t").alias("h"), F.explode(pieces).alias("p")).select("id", "h", "p.*")
    key = ["id", "h"]
    # equal rows: each has its mark, and all else is counted once
    found = found.groupBy(*key, "kind", "i").agg(
        F.first("gap").alias("gap"), F.first("hit").alias("hit"), F.first("counts").alias("counts"),
        F.count(F.lit(1)).alias("times"),
    )
    walk = Window.partitionBy(*key, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = found.withColumn("end", F.sum(F.col("gap") + F.col("hit")).over(walk))
    placed = placed.withColumn("start", F.col("end") - F.col("hit")).filter((F.col("kind") == "") | F.col("counts"))

    order = F.array_position(F.array(*map(F.lit, ["", "|", *KINDS])), F.col("kind")).alias("rank")
    placed = placed.select(*key, "kind", "start", "end", "times", order)
    before = Window.partitionBy(*key).orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*key).orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, -1)
    is_base = F.col("kind").isin(*BASE)
    upto = F.max(F.when(F.col("kind") == "endpoint", F.col("end"))).over(before)
    inside = (F.col("kind") == "opaque") & (F.coalesce(upto, F.lit(0)) >= F.col("end"))
    placed = placed.withColumn("inside", inside)
    parts = {
        "identifier": F.col("kind").isin("access", "client"),
        "secret": F.col("kind").isin("assign", "hex", "opaque") & ~F.col("inside"),
        "endpoint": F.col("kind") == "endpoint",
    }
    # a base span hides the weak ones that it overlaps, so its own ends are told from starts alone
    seen = placed.withColumns({
        "last_base": F.max(F.when(is_base, F.col("end"))).over(before),
        "next_base": F.min(F.when(is_base, F.col("start"))).over(after),
    })
    seen = _around(seen, key, parts | {"scope": F.col("kind") == "|"})

    def near(kind: str) -> Column:
        """A part of this kind before or behind, in the same scope."""
        back, ahead = F.col(f"last_{kind}"), F.col(f"next_{kind}")
        return F.coalesce(back >= F.coalesce("last_scope", F.lit(0)), F.lit(False)) | F.coalesce(
            ahead <= F.coalesce("next_scope", ahead), F.lit(False)
        )

    inside_base = F.coalesce(F.col("last_base") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col("next_base") < F.col("end"), F.lit(False)
    )
    linked = (
        ((F.col("kind") == "client") & near("secret"))
        | (
            (F.col("kind") == "opaque")
            & (near("identifier") | F.when(F.col("inside"), near("secret")).otherwise(near("endpoint")))
        )
        | ((F.col("kind") == "endpoint") & near("identifier") & near("secret"))
    )
    kept = seen.withColumn("keep", is_base | (linked & ~inside_base))
    span = F.struct("start", "rank", "kind", "end")
    grouped = kept.groupBy(*key).agg(
        F.max(F.when(F.col("kind") == "", F.col("times"))).alias("times"),
        F.array_sort(F.collect_list(F.when(F.col("keep"), span))).alias("spans"),
    )
    spans = F.transform(
        "spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    return grouped.select(
        F.col("id").alias(id_col), F.col("h").alias("text_hash"), spans.alias("spans"),
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_copy"),
    ).drop("_copy")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with every span in the text replaced by its kind in brackets; all columns stay.

    Overlapping spans become one, named after the first. Rows without spans stay as they are, and where they are: only
    texts with spans are shuffled.
    """
    key = ["__id", "__hash"]
    found = find_secrets(docs, id_col, text_col).filter(F.size("spans") > 0)
    found = found.dropDuplicates([id_col, "text_hash"]).select(
        F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"), F.posexplode("spans").alias("i", "s")
    )
    earlier = Window.partitionBy(*key).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*key).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    found = found.select(*key, "i", "s.*").withColumn("reached", F.max("end").over(earlier))
    found = found.withColumn("island", F.sum((F.coalesce("reached", F.lit(-1)) <= F.col("start")).cast("int")).over(upto))
    islands = found.groupBy(*key, "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", "i").alias("kind")
    )
    behind = F.coalesce(F.lag("end").over(Window.partitionBy(*key).orderBy("start")), F.lit(0))
    islands = islands.withColumn("behind", behind)
    islands = islands.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind", "behind"))).alias("__spans")
    )
    islands = cut_lineage(islands)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    node = lambda i, h: F.xxhash64(i, h)
    rows = marked(docs, node(F.col(f"`{id_col}`"), F.xxhash64(text)), islands.select(node(F.col("__id"), F.col("__hash")).alias("node")))
    hit = rows.filter("__hit")
    both = hit.join(
        islands, F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left"
    )
    pieces = F.transform(
        "__spans",
        lambda s: F.concat(
            F.substring(text, s["behind"].cast("int") + 1, (s["start"] - s["behind"]).cast("int")),
            F.lit("["), s["kind"], F.lit("]"),
        ),
    )
    last = F.element_at("__spans", -1)["end"].cast("int")
    whole = F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.char_length(text)))
    own = F.when(F.col("__spans").isNotNull(), whole).otherwise(F.col(f"`{text_col}`"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    changed = both.select(*(own.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
    return rows.filter("not __hit").select(*columns).unionByName(changed)
