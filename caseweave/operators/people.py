"""People register: harvest, alias clusters, metrics, ranking, decisions, denylist checks."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing, spans, stats, text as tx, vocab
from ..session import cut_lineage
from .latest import latest_per_key

# ---- harvest ---------------------------------------------------------------


def header_people(docs: DataFrame) -> DataFrame:
    """Name and address pairs from mail header lines, one row per address."""
    lines = F.regexp_extract_all("text", F.lit(vocab.HEADER_LINE), F.lit(0))
    rows = docs.select("case_id", "ref", F.posexplode(lines).alias("line_no", "line"))
    rows = rows.select(
        "case_id",
        "ref",
        "line_no",
        F.lower(F.regexp_extract("line", r"^([^:]+):", 1)).alias("header"),
        F.posexplode(F.split(F.regexp_extract("line", r"^[^:]+:[ \t]*(.*)$", 1), r"[,;]")).alias("pos", "entry"),
    )
    email = F.lower(F.regexp_extract("entry", vocab.EMAIL, 0))
    name = tx.strip(F.regexp_replace(F.regexp_replace("entry", r"<[^>]*>", ""), r"[\"']", ""))
    return (
        rows.withColumns({"email": email, "display_name": name})
        .withColumn("display_name", F.when(F.lower("display_name") == F.col("email"), "").otherwise(F.col("display_name")))
        .filter("email <> '' or display_name <> ''")
        .select(
            "case_id", "ref", "header", "line_no", "pos", "email", "display_name",
            F.lit(vocab.HARVEST_CONFIDENCE["anchored"]).alias("confidence"),
        )
    )


def signature_people(docs: DataFrame) -> DataFrame:
    """Names in signature regions, each with the confidence of how it was found.

    A name after a signing keyword is `anchored`; one on the line under a drawn line alone is
    `underscore`; a line of capitalised words among the last five is `last_lines`. The best origin
    of a name in a document wins.
    """
    text = F.col("text")
    anchor = r"(?im)^[ \t]*(?:Signatory|Signed by|Executed by|Print Name|Name)[ \t]*:[ \t_]*([^\n_]{2,80}?)[ \t_]*$"
    drawn = r"(?m)^[ \t]*_{5,}[ \t]*\n[ \t]*([^\n:]{2,80}?)[ \t]*$"
    lines = F.split(text, "\n")
    last = F.slice(lines, F.greatest(F.size(lines) - 4, F.lit(1)), F.lit(5))
    name_line = F.lit(r"^[\p{Lu}][\p{L}'.-]+(?: [\p{Lu}][\p{L}'.-]+){1,3}$")
    found = {
        "anchored": F.regexp_extract_all(text, F.lit(anchor), F.lit(1)),
        "underscore": F.regexp_extract_all(text, F.lit(drawn), F.lit(1)),
        "last_lines": F.filter(F.transform(last, lambda x: F.trim(x)), lambda x: F.rlike(x, name_line)),
    }

    def labelled(names: Column, origin: str) -> Column:
        return F.transform(
            names,
            lambda n: F.struct(
                tx.strip(n).alias("display_name"),
                F.lit(origin).alias("origin"),
                F.lit(vocab.HARVEST_CONFIDENCE[origin]).alias("confidence"),
            ),
        )

    parts = [labelled(names, origin) for origin, names in found.items()]
    rows = docs.select("case_id", "ref", F.explode(F.concat(*parts)).alias("p")).select("case_id", "ref", "p.*")
    best = F.max_by("origin", F.struct("confidence", "origin"))
    return rows.filter("display_name <> ''").groupBy("case_id", "ref", "display_name").agg(
        best.alias("origin"), F.max("confidence").alias("confidence")
    )


def signature_candidates(docs: DataFrame, people: DataFrame, reach: int = 250) -> DataFrame:
    """Phone labels and capitalised titles, tied to the nearest known person of the document.

    docs: case_id, ref, text. people: case_id, ref, cluster_id, start, end (mentions). A candidate
    with nobody within `reach` characters becomes a new entry of confidence 0.5.
    """
    found = F.concat(
        spans.pattern_spans(F.col("text"), vocab.PHONE_LABEL, "phone_label", F.contains("text", F.lit(":"))),
        F.filter(
            spans.pattern_spans(F.col("text"), vocab.TITLE_CAPS, "title_caps"),
            lambda s: ~F.regexp_replace(s["text"], r"\s+", " ").isin(*vocab.TITLE_ALLOWED),
        ),
    )
    hits = docs.select("case_id", "ref", F.explode(found).alias("s")).select("case_id", "ref", "s.*")
    per_doc = people.groupBy("case_id", "ref").agg(
        F.collect_list(F.struct("start", "end", "cluster_id")).alias("known")
    )
    rows = hits.join(per_doc, ["case_id", "ref"], "left")
    gaps = F.transform(
        "known",
        lambda k: F.struct(
            F.greatest(F.col("start") - k["end"], k["start"] - F.col("end"), F.lit(0)).alias("gap"),
            k["cluster_id"].alias("cluster_id"),
        ),
    )
    near = F.array_min(F.filter(gaps, lambda g: g["gap"] <= reach))
    return rows.withColumn("near", near).select(
        "case_id", "ref", "start", "end", "text", "type",
        F.col("near.cluster_id").alias("cluster_id"),
        F.when(F.col("near").isNull(), "new_candidate").otherwise("attached").alias("outcome"),
        F.when(F.col("near").isNull(), 0.5).alias("confidence"),
        F.lit("sig_block_discovery").alias("discovered_by"),
    )


def choose_strategy(candidates: DataFrame) -> DataFrame:
    """Source strategy per case: confidence, then priority, then name; zero confidence never wins.

    candidates: case_id, name, confidence, priority, is_universal_fallback.
    """
    best = F.struct(
        (F.col("confidence") > 0).alias("positive"),
        F.when(F.col("confidence") > 0, F.col("confidence")).otherwise(0.0).alias("confidence"),
        F.col("priority"),
    )
    usable = candidates.filter("confidence > 0 or is_universal_fallback").withColumn("_key", best)
    order = Window.partitionBy("case_id").orderBy(F.desc("_key"), "name")
    return (
        usable.withColumn("rn", F.row_number().over(order)).filter("rn = 1").select("case_id", "name", "confidence", "priority")
    )


def strategy_candidates(register: DataFrame) -> DataFrame:
    """Confidence of the built-in strategies from what the register of a case holds."""
    n = F.count(F.lit(1))
    share = register.groupBy("case_id").agg(
        (F.count_if(F.coalesce("mailbox_owner_email", F.lit("")) != "") / n).alias("nested"),
        (F.count_if(F.lower(F.coalesce("filename", F.lit(""))).rlike(r"\.(eml|msg)$") & (F.coalesce("mailbox_owner_email", F.lit("")) == "")) / n).alias("flat"),
        (F.count_if(F.lower(F.coalesce("filename", F.lit(""))).rlike(r"\.(docx|xlsx|pptx|pdf)$")) / n).alias("office"),
    )
    options = F.array(
        *[
            F.struct(F.lit(name).alias("name"), conf.cast("double").alias("confidence"), F.lit(prio).alias("priority"), F.lit(last).alias("is_universal_fallback"))
            for name, conf, prio, last in [
                ("exchange_nested", F.col("nested"), 110, False),
                ("exchange_flat", F.col("flat"), 100, False),
                ("sharepoint", F.col("office"), 100, False),
                ("raw_dump", F.lit(0.0), 50, True),
            ]
        ]
    )
    return share.select("case_id", F.inline(options))


# ---- alias clusters --------------------------------------------------------


def _grams(name: Column) -> Column:
    """Distinct character trigrams of a padded name, each as one number (three code points)."""
    padded = F.concat(F.lit("  "), name, F.lit(" "))
    points = F.transform(F.split(padded, ""), lambda c: F.ascii(c).cast("bigint"))
    return F.array_distinct(
        F.transform(
            F.sequence(F.lit(1), F.char_length(padded) - 2),
            lambda i: (F.element_at(points, i) * (1 << 42))
            + (F.element_at(points, i + 1) * (1 << 21))
            + F.element_at(points, i + 2),
        )
    )


#: Rows of a block. A larger bucket is cut into blocks, and each pair of blocks is compared in one place.
BLOCK = 3000
#: Comparisons that a task makes on average.
TASK_PAIRS = 50_000_000


def _marks(grams: Column, half: int) -> Column:
    """Half 0 or 1 of a map of 128 bits, as a number: each trigram of the set marks one bit."""

    def mark(bits: Column, g: Column) -> Column:
        h = F.xxhash64(g)
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(h, F.lit(64)).cast("int"))
        return bits.bitwiseOR(F.when(F.pmod(h, F.lit(128)) >= 64, one if half else F.lit(0)).otherwise(F.lit(0) if half else one))

    return F.aggregate(grams, F.lit(0).cast("bigint"), mark)


def _gram_sets(names: DataFrame, threshold: float) -> DataFrame:
    """case_id, name, wanted, n, grams (rarest first), keep, how many of them decide, and a bit map of them (low, high)
    of each distinct name."""
    wanted = F.bool_or("wanted") if "wanted" in names.columns else F.lit(True)
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # names are few bytes and much work: adaptive execution would put them into one task
    # (in this order of columns, as one that the rows have already would be left out)
    deal = lambda rows: rows.repartition(parts, "name", "case_id")
    distinct = deal(names.filter("name <> ''").groupBy("case_id", "name").agg(wanted.alias("wanted")))
    sets = distinct.withColumn("grams", spans.once(_grams(F.col("name"))))
    freq = sets.select("case_id", F.explode("grams").alias("g")).groupBy("case_id", "g").agg(F.count(F.lit(1)).alias("df"))
    ordered = (
        deal(sets.select("case_id", "name", "wanted", F.explode("grams").alias("g")).join(freq, ["case_id", "g"], "inner"))
        .groupBy("case_id", "name", "wanted")
        .agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("o"))
        .withColumn("grams", spans.once(F.transform("o", lambda x: x["g"])))
        .withColumn("n", F.size("grams"))
    )
    keep = (F.col("n") - F.ceil(F.lit(threshold * threshold) * F.col("n")) + 1).cast("int")
    return ordered.select(
        "case_id", "name", "wanted", "n", "grams", keep.alias("keep"),
        _marks(F.col("grams"), 0).alias("low"), _marks(F.col("grams"), 1).alias("high"),
    )


def _rare(sets: DataFrame, *carry: str) -> DataFrame:
    """A row for each of the rare trigrams of a name: two similar names share one."""
    rare = F.posexplode(F.slice("grams", F.lit(1), F.col("keep"))).alias("pos", "g")
    return sets.select("case_id", "name", "n", "low", "high", *carry, rare)


def _may_be_similar(n: Column, pos: Column, m: Column, at: Column, threshold: float) -> Column:
    """Whether sets of n and m whose common trigram stands at pos and at may reach the threshold: sizes are not too
    far apart, and what is left from there on, which bounds the common part, is enough."""
    left = F.least(n - pos, m - at)
    square = threshold * threshold
    return (n * square <= m) & (m * square <= n) & (left >= threshold * F.sqrt(n * m) - 1e-9)


def _enough_in_common(threshold: float) -> Column:
    """Whether sets a and b may reach the threshold by their bit maps: a bit that only one has marked is a trigram, at
    least, that the other lacks."""

    def rest(x: str, y: str) -> Column:
        lacks = [F.bit_count(F.col(f"{x}.{c}").bitwiseAND(F.bitwise_not(F.col(f"{y}.{c}")))) for c in ("low", "high")]
        return F.col(f"{x}.n") - lacks[0] - lacks[1]

    return F.least(rest("a", "b"), rest("b", "a")) >= threshold * F.sqrt(F.col("a.n") * F.col("b.n")) - 1e-9


def _meet(a: DataFrame, b: DataFrame, sizes: DataFrame, fits: Column, mirror: bool = False) -> DataFrame:
    """The rows of a with the rows of b that stand in the same bucket (case_id, g) and fit, as a.* and b.*.

    sizes: case_id, g, ka and kb, the rows of either side. With `mirror` both sides are the same rows, and each
    pair of names comes once. Comparisons grow with the square of a bucket, so buckets are cut into blocks and the number of
    tasks follows the comparisons, not the bytes: a task stays as short as it is, and what a bucket shuffles grows by its
    rows / BLOCK.
    """
    spark, key = sizes.sparkSession, ["case_id", "g", "i", "j"]
    work = sizes.agg(F.sum(F.col("ka").cast("double") * F.col("kb"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(work / (2 if mirror else 1) / TASK_PAIRS))
    blocks = sizes.select("case_id", "g", *(F.ceil(F.col(f"k{x}") / BLOCK).cast("int").alias(f"n{x}") for x in "ab"))
    place = lambda n: F.pmod(F.xxhash64("name"), F.col(n)).cast("int")
    i, j, zero = F.col("i"), F.col("j"), F.lit(0)
    a = a.join(blocks, ["case_id", "g"]).withColumn("i", place("na"))
    a = a.withColumn("j", F.explode(F.sequence(i if mirror else zero, F.col("nb") - 1))).drop("na", "nb")
    b = b.join(blocks, ["case_id", "g"]).withColumn("j", place("nb"))
    b = b.withColumn("i", F.explode(F.sequence(zero, j if mirror else F.col("na") - 1))).drop("na", "nb")
    # dealt by hand: adaptive execution would put the few bytes of many comparisons into one task
    a, b = (x.repartition(tasks, *key).alias(n) for x, n in ((a, "a"), (b, "b")))
    once = (F.col("a.i") < F.col("a.j")) | (F.col("a.name") < F.col("b.name")) if mirror else F.lit(True)
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in key]
    return a.join(b.hint("merge"), same[0] & same[1] & same[2] & same[3] & fits & once)


def similar_names(names: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Pairs of distinct names of a case whose trigram cosine reaches the threshold.

    Exact, without comparing everything with everything: trigrams are ordered from rare to
    common, and two sets that similar must share one of their first |x| - ceil(t^2 |x|) + 1
    rarest trigrams. Only those rare trigrams are joined on, in blocks of bounded size; sizes too far
    apart and sets whose bit maps differ too much are dropped, every candidate is checked, and a pair comes from the first
    trigram it shares. Where `names` has a boolean column `wanted`, only pairs with a wanted side are looked for.
    """
    rare = _rare(cut_lineage(_gram_sets(names, threshold)), "wanted", "grams")
    sizes = rare.groupBy("case_id", "g").agg(F.count(F.lit(1)).alias("ka"), F.bool_or("wanted").alias("any"))
    sizes = cut_lineage(sizes.filter("ka > 1 and any").select("case_id", "g", "ka", F.col("ka").alias("kb")))
    fits = (
        _enough_in_common(threshold)
        & _may_be_similar(F.col("a.n"), F.col("a.pos"), F.col("b.n"), F.col("b.pos"), threshold)
        & (F.col("a.wanted") | F.col("b.wanted"))
    )
    before = F.array_intersect(F.slice("a.grams", F.lit(1), F.col("a.pos")), F.slice("b.grams", F.lit(1), F.col("b.pos")))
    cosine = F.size(F.array_intersect("a.grams", "b.grams")) / F.sqrt(F.col("a.n") * F.col("b.n"))
    # the costly test comes after the cheap ones, not inside the join with them
    return (
        _meet(rare, rare, sizes, fits, mirror=True)
        .select(
            "a.case_id", F.least("a.name", "b.name").alias("name_a"), F.greatest("a.name", "b.name").alias("name_b"),
            spans.once(F.when(F.size(before) == 0, cosine)).alias("similarity"),
        )
        .filter(F.col("similarity") >= threshold - 1e-12)
    )


def components(links: DataFrame) -> DataFrame:
    """Connected components of (case_id, node, key) links: nodes sharing a key belong together.

    Each round takes the smallest label per key and then per node, both pre-combined, so a key
    shared by a large part of all nodes stays a star and is never expanded to pairs; a jump to the
    label's own label shortens chains. Rounds are written to the shared folder and end when no label changes.
    """
    edges = cut_lineage(links.select("case_id", "node", "key").distinct())
    labels = edges.groupBy("case_id", "node").agg(F.min("node").alias("label"))
    while True:
        by_key = edges.join(labels, ["case_id", "node"]).groupBy("case_id", "key").agg(F.min("label").alias("label"))
        reached = edges.join(by_key, ["case_id", "key"]).groupBy("case_id", "node").agg(F.min("label").alias("label"))
        jump = reached.select("case_id", F.col("node").alias("label"), F.col("label").alias("up"))
        before = labels.withColumnRenamed("label", "old")
        labels = cut_lineage(
            reached.join(jump, ["case_id", "label"], "left")
            .join(before, ["case_id", "node"])
            .select("case_id", "node", F.least("label", F.coalesce("up", "label")).alias("label"), "old")
        )
        if labels.filter(F.col("label") != F.col("old")).isEmpty():
            return labels.drop("old")
        labels = labels.drop("old")


def name_forest(names: DataFrame, known: DataFrame, threshold: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """Links that join all names of a case whose trigram cosine reaches the threshold, and the labels they give.

    names: case_id, name. known: links (case_id, node, key) that hold already; the node of a name is `name:` before it.
    The links join the same names as all similar pairs would, but a family of n names needs little more than n of them: in
    the largest bucket of a rare trigram that it stands in, each name is compared with one name of the bucket, the centre. As
    long as that halves the pairs that are left apart, other centres follow, in all buckets. Then every name outside the largest component of its bucket is
    compared with the names there that are not in its own component, so that no two names stay both uncompared and apart.
    """
    sets = cut_lineage(_gram_sets(names, threshold).drop("wanted"))
    rare = _rare(sets)
    shared = rare.groupBy("case_id", "g").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("case_id", "g")
    members = cut_lineage(rare.join(shared, ["case_id", "g"]))
    sizes = members.groupBy("case_id", "g").agg(F.count(F.lit(1)).alias("k"))
    total, before = sizes.agg(F.coalesce(F.sum("k"), F.lit(0)), F.sum(F.col("k") * F.col("k"))).first()
    named = members.withColumns({"node": F.concat(F.lit("name:"), "name"), "label": F.concat(F.lit("name:"), "name")})
    links, labels = known, None

    apart = F.col("a.label") != F.col("b.label")
    enough = _enough_in_common(threshold)

    def linked(met: DataFrame) -> DataFrame:
        """Links of the pairs a and b that met and are similar."""
        pairs = met.select("a.case_id", F.least("a.name", "b.name").alias("a"), F.greatest("a.name", "b.name").alias("b")).distinct()
        key = F.concat(F.lit("pair:"), "a", F.lit("\x1f"), "b")
        both = F.explode(F.array(F.concat(F.lit("name:"), "a"), F.concat(F.lit("name:"), "b")))
        return cut_lineage(_similar(pairs, sets, threshold).select("case_id", both.alias("node"), key.alias("key")))

    # what the place of a trigram says holds for the first that two names share, so it decides only where all meet
    fits = enough & _may_be_similar(F.col("a.n"), F.col("a.pos"), F.col("b.n"), F.col("b.pos"), threshold)

    def by_centre(some: DataFrame, named: DataFrame, turn: int) -> DataFrame:
        """Links of some members to the centre of their bucket, where that has another label."""
        one = named.groupBy("case_id", "g").agg(F.min_by("name", F.xxhash64("name", F.lit(turn))).alias("name"))
        a, b = some.alias("a"), named.join(one, ["case_id", "g", "name"], "left_semi").alias("b")
        same = (F.col("a.case_id") == F.col("b.case_id")) & (F.col("a.g") == F.col("b.g"))
        return linked(a.join(b, same & enough & apart & (F.col("a.name") != F.col("b.name"))))

    for turn in itertools.count() if total else ():
        if not turn:
            of_name = members.join(sizes, ["case_id", "g"]).groupBy("case_id", "name").agg(F.max_by("g", F.struct("k", "g")).alias("g"))
            found = by_centre(named.join(of_name, ["case_id", "name", "g"], "left_semi"), named, turn)
            if found.count() * 20 < sets.count():  # no families: all meet at once
                both = sizes.select("case_id", "g", F.col("k").alias("ka"), F.col("k").alias("kb"))
                links = links.unionByName(linked(_meet(members, members, both, fits, mirror=True)))
                break
        else:
            named = members.withColumn("node", F.concat(F.lit("name:"), "name")).join(labels, ["case_id", "node"], "left")
            named = named.withColumn("label", F.coalesce("label", "node"))
            parts = named.groupBy("case_id", "g", "label").agg(F.count(F.lit(1)).alias("k"))
            largest = parts.groupBy("case_id", "g").agg(
                F.max_by("label", F.struct("k", "label")).alias("largest"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("parts")
            )
            named = cut_lineage(named.join(largest.filter("parts > 1"), ["case_id", "g"]))
            outside = named.filter("label <> largest")
            left = outside.agg(F.sum("k")).first()[0] or 0
            if not left:
                break
            if left <= 4 * total or 2 * left > before:
                both = outside.groupBy("case_id", "g").agg(F.first("k").alias("ka"), F.count(F.lit(1)).alias("kb"))
                links = links.unionByName(linked(_meet(*(x.select(*members.columns, "label") for x in (named, outside)), both, fits & apart)))
                labels = None
                break
            before = left
            found = by_centre(named, named, turn)
        links = cut_lineage(links.unionByName(found))
        labels = components(links)
    links = cut_lineage(links)
    return links, components(links) if labels is None else labels


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs of names (case_id, a, b) whose trigram cosine reaches the threshold."""
    side = lambda c: sets.select("case_id", F.col("name").alias(c), F.col("n").alias(f"n{c}"), F.col("grams").alias(f"g{c}"))
    cosine = F.size(F.array_intersect("ga", "gb")) / F.sqrt(F.col("na") * F.col("nb"))
    return pairs.join(side("a"), ["case_id", "a"]).join(side("b"), ["case_id", "b"]).filter(cosine >= threshold - 1e-12).select("case_id", "a", "b")


def alias_clusters(mentions: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Cluster label per mention (case_id, mention_id, name, email, phone).

    Mentions are one person when they share an e-mail address or a phone number, have the same
    name, or have names whose trigram cosine reaches the threshold. Mentions of one name are one
    node from the start, and only keys that join two nodes take part in the rounds. A cluster is
    labelled by its smallest node: `name:...`, or `self:...` for a mention without a name.
    """
    name = F.lower(tx.strip(F.regexp_replace(F.coalesce("name", F.lit("")), r"(?U)\s+", " ")))
    own = F.concat(F.lit("self:"), F.col("mention_id").cast("string"))
    rows = mentions.withColumn("name", name)
    rows = rows.withColumn("node", F.when(F.col("name") != "", F.concat(F.lit("name:"), "name")).otherwise(own))

    def keyed(kind: str, value: Column) -> DataFrame:
        return rows.select("case_id", "node", F.concat(F.lit(kind + ":"), value).alias("key")).filter(
            F.coalesce(value, F.lit("")) != ""
        )

    contact = keyed("mail", F.lower(F.trim("email"))).unionByName(
        keyed("phone", F.regexp_replace(F.coalesce("phone", F.lit("")), r"[^0-9+]", ""))
    )
    contact = contact.distinct()
    shared = contact.groupBy("case_id", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("case_id", "key")
    known = contact.join(shared, ["case_id", "key"], "left_semi").select("case_id", "node", "key")
    _, labels = name_forest(rows, known, threshold)
    return rows.join(labels, ["case_id", "node"], "left").select(
        "case_id", F.col("mention_id").cast("string").alias("mention_id"), F.coalesce("label", "node").alias("cluster")
    )


def cluster_metrics(mentions: DataFrame) -> DataFrame:
    """Mentions, distinct documents, lowest confidence and highest subject confidence per cluster."""
    per_doc = mentions.groupBy("case_id", "cluster", "ref").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("confidence").alias("c"),
        F.max("is_subject_confidence").alias("s"),
    )
    return per_doc.groupBy("case_id", "cluster").agg(
        F.sum("n").alias("mention_count"),
        F.count(F.lit(1)).alias("distinct_doc_count"),
        F.min("c").alias("confidence_score"),
        F.max("s").alias("is_subject_confidence"),
    )


def quality_mode(rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Most common text quality per group; on a tie the most cautious band wins."""
    order = order or vocab.TEXT_QUALITY_ORDER
    place = stats.lookup({q: i for i, q in enumerate(order)}, F.col("text_quality"), F.lit(len(order)))
    counts = rows.groupBy(*keys, "text_quality").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(
        F.max_by("text_quality", F.struct(F.col("n"), (-place).alias("p"))).alias("text_quality_summary")
    )


def centricity(header_share: Column, pronoun_share: Column) -> Column:
    """Advisory subject centricity; the pronoun share comes from a language model of the caller."""
    return 0.6 * header_share + 0.4 * F.coalesce(pronoun_share, F.lit(0.0))


def header_proximity(mentions: DataFrame, subject_lines: DataFrame, reach: int = 2) -> DataFrame:
    """Share of a cluster's documents where it stands within `reach` header lines of the subject.

    Lines are expanded to the few neighbours in reach, so this is an equi-join.
    """
    near = subject_lines.select(
        "case_id", "ref", F.explode(F.sequence(F.col("line_no") - reach, F.col("line_no") + reach)).alias("line_no")
    ).distinct()
    docs = mentions.select("case_id", "cluster", "ref").distinct().groupBy("case_id", "cluster").agg(
        F.count(F.lit(1)).alias("n_docs")
    )
    close = (
        mentions.join(near, ["case_id", "ref", "line_no"], "left_semi")
        .select("case_id", "cluster", "ref")
        .distinct()
        .groupBy("case_id", "cluster")
        .agg(F.count(F.lit(1)).alias("n_close"))
    )
    return docs.join(close, ["case_id", "cluster"], "left").select(
        "case_id", "cluster", (F.coalesce("n_close", F.lit(0)) / F.col("n_docs")).alias("header_share")
    )


# ---- ranking ---------------------------------------------------------------


def ranking_score() -> Column:
    """mentions x documents x (1 - subject confidence); anything unreadable scores zero."""
    part = lambda c: F.when(F.col(c).isNull(), 0.0).otherwise(F.col(c).try_cast("double"))
    score = part("mention_count") * part("distinct_doc_count") * (1 - part("is_subject_confidence"))
    return F.coalesce(score, F.lit(0.0))


def top_people(clusters: DataFrame, n: int = 50) -> DataFrame:
    """The n third parties of each case with the highest ranking score, ties by name."""
    others = clusters.filter(~F.coalesce("is_data_subject", F.lit(False))).withColumn("ranking_score", ranking_score())
    order = Window.partitionBy("case_id").orderBy(F.desc("ranking_score"), F.coalesce("canonical_name", F.lit("")))
    return others.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def referent_candidates(clusters: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Third parties whose centricity is strictly above the threshold, for review."""
    score = F.coalesce("subject_centricity_score", F.lit(0.0))
    return clusters.filter(~F.coalesce("is_data_subject", F.lit(False)) & (score > threshold)).withColumn(
        "subject_centricity_score", score
    )


def dual_juror(clusters: DataFrame, cases: DataFrame) -> DataFrame:
    """Whether a case needs two jurors: asked for, vulnerable subject, or an uncertain top 50."""
    unsure = top_people(clusters).groupBy("case_id").agg(
        F.avg((F.coalesce("is_subject_confidence", F.lit(0.0)) < 0.85).cast("double")).alias("unsure_share")
    )
    rows = cases.join(unsure, "case_id", "left").withColumn("unsure_share", F.coalesce("unsure_share", F.lit(0.0)))
    flag = F.coalesce("dual_juror", F.lit(False)) | F.coalesce("vulnerable", F.lit(False)) | (F.col("unsure_share") >= 0.2)
    return rows.select("case_id", "unsure_share", flag.alias("dual"))


# ---- decisions -------------------------------------------------------------


def applied_merges(decisions: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """Merges that take effect: case_id, cluster_id, target and seq, at most one per cluster.

    Decisions apply in the order of `seq`. A merge that applies removes its cluster, so later decisions on this
    cluster and later merges into it are refused; so are merges of a cluster into itself and, where `clusters`
    is given, merges of or into clusters that are not in it. Applied merges cannot form a cycle.

    A merge depends on earlier ones only. Each round settles those that are the first open merge of their
    source and earlier than every open merge of their target, in all cases at once.
    """
    rows = decisions.filter("action = 'merge_with' and merge_target_id <> '' and merge_target_id <> cluster_id").select(
        "case_id", "cluster_id", F.col("merge_target_id").alias("target"), "seq"
    )
    if clusters is not None:
        known = clusters.select("case_id", "cluster_id").distinct()
        rows = rows.join(known, ["case_id", "cluster_id"], "left_semi")
        rows = rows.join(known.withColumnRenamed("cluster_id", "target"), ["case_id", "target"], "left_semi")
    order = F.struct("seq", "cluster_id", "target")  # equal seq: any fixed order
    waiting = cut_lineage(rows.select("case_id", "cluster_id", "target", "seq", order.alias("at")).distinct())
    applied = waiting.limit(0)
    while not waiting.isEmpty():
        first = waiting.groupBy("case_id", "cluster_id").agg(F.min("at").alias("own"))
        of_target = first.select("case_id", F.col("cluster_id").alias("target"), F.col("own").alias("other"))
        ready = waiting.join(first, ["case_id", "cluster_id"]).filter(F.col("at") == F.col("own"))
        ready = ready.join(of_target, ["case_id", "target"], "left").filter("other is null or at < other")
        now = cut_lineage(ready.select(*waiting.columns))
        applied = applied.unionByName(now)
        gone = now.select("case_id", F.col("cluster_id").alias("target"), F.col("at").alias("gone"))
        rest = waiting.join(now, ["case_id", "cluster_id"], "left_anti").join(gone, ["case_id", "target"], "left")
        waiting = cut_lineage(rest.filter("gone is null or at < gone").select(*waiting.columns))
    return applied.drop("at")


def merge_targets(decisions: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """Final target of every cluster that was merged away; chains of applied merges are followed to their end."""
    step = applied_merges(decisions, clusters).select("case_id", "cluster_id", "target")
    while True:
        up = step.select("case_id", F.col("cluster_id").alias("target"), F.col("target").alias("up"))
        moved = cut_lineage(step.join(up, ["case_id", "target"], "left"))
        step = moved.select("case_id", "cluster_id", F.coalesce("up", "target").alias("target"))
        if moved.filter("up is not null").isEmpty():
            return step


def merged_members(members: DataFrame, targets: DataFrame) -> DataFrame:
    """Cluster attributes after merging, one row per distinct (cluster, kind, value).

    members: case_id, cluster_id, kind (email / phone / title / source_ref / correlation_id),
    value. The long form lets a cluster that absorbed many others stay spread out.
    """
    return (
        members.join(targets, ["case_id", "cluster_id"], "left")
        .select("case_id", F.coalesce("target", "cluster_id").alias("cluster_id"), "kind", "value")
        .distinct()
    )


def merged_counts(clusters: DataFrame, members: DataFrame, targets: DataFrame) -> DataFrame:
    """Mentions added up over merged clusters, documents recounted from the union of their refs."""
    moved = clusters.join(targets, ["case_id", "cluster_id"], "left").select(
        "case_id", F.coalesce("target", "cluster_id").alias("cluster_id"), "mention_count"
    )
    mentions = moved.groupBy("case_id", "cluster_id").agg(
        F.sum("mention_count").alias("mention_count"), F.count(F.lit(1)).alias("merged_clusters")
    )
    docs = (
        merged_members(members.filter("kind = 'source_ref'"), targets)
        .groupBy("case_id", "cluster_id")
        .agg(F.count(F.lit(1)).alias("distinct_doc_count"))
    )
    return mentions.join(docs, ["case_id", "cluster_id"], "left").na.fill(0, ["distinct_doc_count"])


def decided_denylist(clusters: DataFrame, decisions: DataFrame) -> DataFrame:
    """Denylist from the last applied decision per cluster: accepted third parties redact, preserved ones do not.

    Clusters merged away or last marked as the subject's alias have no entry; refused merges leave entries alone.
    """
    kinds = "action in ('accept_as_third_party', 'preserve', 'mark_subject_alias')"
    last = latest_per_key(
        decisions.filter(kinds).select("case_id", "cluster_id", "seq", "action", "note"), ["case_id", "cluster_id"]
    )
    rows = clusters.select("case_id", "cluster_id", "canonical_name").join(last, ["case_id", "cluster_id"], "inner")
    rows = rows.join(applied_merges(decisions, clusters), ["case_id", "cluster_id"], "left_anti")
    return rows.filter("action <> 'mark_subject_alias'").select(
        "case_id", "cluster_id", "canonical_name",
        (F.col("action") == "accept_as_third_party").alias("redact"),
        F.coalesce("note", F.lit("")).alias("operator_note"),
    )


def subject_aliases(
    clusters: DataFrame, members: DataFrame, decisions: DataFrame, subjects: DataFrame | None = None
) -> DataFrame:
    """Names, addresses and phones folded into the subject, one distinct value per row.

    A mark stays for good, whatever is decided later, and also takes the addresses and phones of clusters merged
    in before it. Marks on clusters already merged away are refused. The subject's own name and address
    (subjects: case_id, full_name, email) are left out.
    """
    merges = cut_lineage(applied_merges(decisions, clusters))
    gone = merges.select("case_id", "cluster_id", F.col("seq").alias("gone"))
    marks = decisions.filter("action = 'mark_subject_alias'").join(gone, ["case_id", "cluster_id"], "left")
    marks = marks.filter("gone is null or seq < gone").groupBy("case_id", "cluster_id").agg(F.max("seq").alias("before"))
    marks = cut_lineage(marks.join(clusters, ["case_id", "cluster_id"], "left_semi"))
    into = merges.select("case_id", F.col("target").alias("cluster_id"), F.col("cluster_id").alias("source"), "seq")
    folded = level = marks
    while True:
        level = into.join(level, ["case_id", "cluster_id"]).filter("seq < before").groupBy("case_id", "source").agg(
            F.max("seq").alias("before")
        )
        level = cut_lineage(level.withColumnRenamed("source", "cluster_id"))
        if level.isEmpty():
            break
        folded = folded.unionByName(level)
    names = clusters.join(marks, ["case_id", "cluster_id"], "left_semi").select(
        "case_id", F.lit("alias").alias("kind"), F.col("canonical_name").alias("value")
    )
    rest = members.filter("kind in ('email', 'phone')").join(folded, ["case_id", "cluster_id"], "left_semi")
    found = names.unionByName(rest.select("case_id", "kind", "value")).filter("value <> ''").distinct()
    if subjects is None:
        return found
    own = subjects.select("case_id", F.expr("stack(2, 'alias', full_name, 'email', email) as (kind, value)"))
    return found.join(own, ["case_id", "kind", "value"], "left_anti")


# ---- denylist --------------------------------------------------------------


def name_similarity(a: Column, b: Column) -> Column:
    """Trigram cosine of two names."""
    x, y = _grams(F.lower(a)), _grams(F.lower(b))
    return F.size(F.array_intersect(x, y)) / F.sqrt(F.size(x) * F.size(y))


def denylist_violations(denylist: DataFrame, subjects: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Denylist entries that resemble the subject, from vectors supplied by the caller.

    denylist: case_id, canonical_name, vector. subjects: case_id, vectors (the few vectors of the
    subject's names). The join is on the case; each entry is compared with its own subject only.
    """
    rows = denylist.join(subjects, "case_id", "inner")
    best = F.array_max(F.transform("vectors", lambda v: stats.cosine(F.col("vector"), v)))
    return rows.withColumn("max_similarity", best).filter(F.col("max_similarity") > threshold).select(
        "case_id", "canonical_name", "max_similarity"
    )


def denylist_hits(tokens: DataFrame, denylist: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Tokens forced to redaction: e-mail or phone equal to an entry's, or a name close to one.

    tokens: case_id, ref, kind (email / phone / name), value. Names are compared once per
    distinct value through the rare-trigram join, then matched back by equality.
    """
    value = F.when(F.col("kind") == "phone", F.regexp_replace("value", r"[^0-9+]", "")).otherwise(F.lower(F.trim("value")))
    rows = tokens.withColumn("norm", value)
    deny = denylist.filter("redact").select("case_id", "kind", value.alias("norm")).distinct()
    exact = rows.join(deny, ["case_id", "kind", "norm"], "left_semi").withColumn("match", F.lit("exact"))
    deny_names = deny.filter("kind = 'name'").select("case_id", F.col("norm").alias("name"))
    token_names = rows.filter("kind = 'name'").select("case_id", F.col("norm").alias("name")).distinct()
    both = deny_names.withColumn("wanted", F.lit(True)).unionByName(token_names.withColumn("wanted", F.lit(False)))
    pairs = similar_names(both, threshold)
    either = pairs.select("case_id", F.col("name_a").alias("norm"), F.col("name_b").alias("name")).unionByName(
        pairs.select("case_id", F.col("name_b").alias("norm"), F.col("name_a").alias("name"))
    )
    close = either.join(deny_names, ["case_id", "name"], "left_semi").select("case_id", "norm").distinct()
    fuzzy = (
        rows.filter("kind = 'name'")
        .join(deny, ["case_id", "kind", "norm"], "left_anti")
        .join(close, ["case_id", "norm"], "left_semi")
        .withColumn("match", F.lit("fuzzy"))
    )
    return exact.unionByName(fuzzy).select("case_id", "ref", "kind", "value", "match")


# ---- gates -----------------------------------------------------------------


def has_communicants(register: DataFrame) -> DataFrame:
    """Per case, whether the corpus holds correspondence."""
    filled = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    mail_file = F.lower(F.coalesce("filename", F.lit(""))).rlike(r"\.(eml|msg)$")
    return register.groupBy("case_id").agg(
        F.bool_or(filled("mailbox_owner_email") | filled("source_kind") | mail_file).alias("communicants")
    )


def register_sufficiency(clusters: DataFrame, register: DataFrame) -> DataFrame:
    """Third-party and subject clusters per case; none at all despite correspondence fails."""
    subject = F.coalesce("is_data_subject", F.lit(False))
    counts = clusters.groupBy("case_id").agg(
        F.count_if(~subject).alias("third_party_clusters"), F.count_if(subject).alias("subject_clusters")
    )
    rows = has_communicants(register).join(counts, "case_id", "left").na.fill(0)
    bad = (F.col("third_party_clusters") == 0) & F.col("communicants")
    return rows.withColumn("gate", F.when(bad, "fail").otherwise("pass"))


def people_coverage(clusters: DataFrame, denylist: DataFrame) -> DataFrame:
    """Persons, addresses, phones, denylist counts and the pre-redaction gate, per case."""
    subject = F.coalesce("is_data_subject", F.lit(False))
    none = spans.empty("string")
    people = clusters.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("persons"),
        F.sum(F.size(F.coalesce("emails", none))).alias("emails"),
        F.sum(F.size(F.coalesce("phones", none))).alias("phones"),
        F.count_if(subject).alias("subject_clusters"),
        F.count_if(~subject).alias("third_party"),
    )
    listed = denylist.groupBy("case_id").agg(
        F.count_if("redact").alias("denylist_redact"), F.count_if(~F.col("redact")).alias("denylist_preserve")
    )
    gate = F.when(F.col("third_party") > 0, "passed").when(F.col("persons") > 0, "blocked").otherwise("empty")
    return people.join(listed, "case_id", "left").na.fill(0).withColumn("gate", gate)


def with_ids(clusters: DataFrame) -> DataFrame:
    """Cluster id from the name (as recorded) and one that also holds the first address."""
    first = F.coalesce(F.try_element_at("emails", F.lit(1)), F.lit(""))
    return clusters.withColumns(
        {
            "cluster_id": hashing.cluster_id(F.col("canonical_name")),
            "cluster_key": hashing.cluster_id(F.concat_ws("\x1f", F.coalesce("canonical_name", F.lit("")), first)),
        }
    )
