"""Line deduplication against levelled sorted runs of line hashes.

Documents come in batches. A batch's distinct line hashes are merged with the runs of all batches before: a hash
that a run holds is an old line, the others (the anti-join) are new and become a sorted run of their own. Runs of
one level are compacted into one run of the next as soon as there are enough of them, so their number grows with
the logarithm of the number of batches. Of a new line the smallest id of its batch is the owner; all other
documents lose it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, run_folder

LEAST_CHARS = 10
BATCHES = 4
FANOUT = 2  # runs of a level that are compacted into one
HOT_KEYS = 20_000  # most rows of the table of hot lines, which is broadcast
HOT_LINES = 1_000  # a line of fewer occurrences in a batch is never hot
KEY = ["h1", "h2"]
_BLANKS = " \t\n\x0b\x0c\r"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class LineRuns:
    """Sorted runs of the line hashes of all batches so far, by level, as tables in the shared folder.

    No hash stands in two runs: a batch only adds what the runs did not hold.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def _written(self, keys: DataFrame) -> DataFrame:
        path = run_folder(self.spark, "line-run")
        keys.select(*KEY).repartition(*KEY).sortWithinPartitions(*KEY).write.parquet(path)
        return self.spark.read.schema("h1 long, h2 long").parquet(path)

    def held(self) -> DataFrame | None:
        """All hashes in all runs."""
        out = None
        for run in (r for level in self.levels for r in level):
            out = run if out is None else out.union(run)
        return out

    def admit(self, lines: DataFrame) -> DataFrame:
        """Merge a batch with the runs and add its new hashes as a run.

        lines: h1, h2, place (the document's position), one row a line. Gives one row for each hash: h1, h2, owner
        (null if an earlier batch had it), last and n, the lines with it.
        """
        found = lines.groupBy(*KEY).agg(
            F.min("place").alias("first"), F.max("place").alias("last"), F.count(F.lit(1)).alias("n")
        )
        held = self.held()
        if held is not None:
            found = found.join(held.withColumn("old", F.lit(True)), KEY, "left")
            found = found.withColumn("first", F.when(F.col("old").isNull(), F.col("first")))
        found = cut_lineage(found.select(*KEY, F.col("first").alias("owner"), "last", "n"))
        self._add(found.filter("owner is not null"))
        return found

    def _add(self, keys: DataFrame) -> None:
        run, level = self._written(keys), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            together, self.levels[level] = self.levels[level], []
            merged = together[0]
            for more in together[1:]:
                merged = merged.union(more)
            run, level = self._written(merged), level + 1


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z in lower case."""
    ascii_only = F.octet_length(line) == F.char_length(line)
    small = F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, _CAPITALS, _SMALL))
    return F.btrim(small, F.lit(_BLANKS))


def _lines(rows: DataFrame, least: int) -> DataFrame:
    """One row for each line whose key has `least` code points: place, twin, pos (from 0), h1, h2."""
    every = rows.select("place", "twin", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = every.filter(F.char_length("line") >= least).select("place", "twin", "pos", line_key(F.col("line")).alias("key"))
    # two independent 64-bit hashes: the second starts from another seed
    return keyed.filter(F.char_length("key") >= least).select(
        "place", "twin", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Documents without the lines that a document of smaller id has too.

    A line's key is the line without ASCII white space at both ends and with A-Z in lower case. Keys of at least
    `least` code points that stand in two or more documents lose all their lines except in the smallest id that
    holds them. One row for each input row: id_col, the columns to carry, n_lines, n_dropped and kept_text (the
    other lines, joined by line ends). A null or empty text is one empty line. Rows that share an id are one
    document. Rows without an id are one document, which comes last. Ids must fit a long. An empty table
    gives an empty one; other columns are not read. A text is one row of one task; its lines are not.
    """
    if clash := {"n_lines", "n_dropped", "kept_text"} & {id_col, *carry}:
        raise ValueError(f"columns {sorted(clash)} have names of results")
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    place = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(2**63 - 1))
    rows = docs.select(
        F.col(f"`{id_col}`"), *(F.col(f"`{c}`") for c in carry), place.alias("__place"), F.xxhash64(text).alias("__twin"),
        text.alias("__text"),
    )
    # ids cut into batches of like size, in their order
    shares = [k / batches for k in range(1, batches)]
    cuts = sorted({min(int(c), 2**63 - 1) for c in rows.approxQuantile("__place", shares, 0.01)}) if shares else []
    batch = sum(((F.col("place") > c).cast("int") for c in cuts), F.lit(0))
    lines = rows.select(F.col("__place").alias("place"), F.col("__twin").alias("twin"), F.col("__text").alias("text"))
    lines = _lines(lines, least).withColumn("batch", batch)
    path = run_folder(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)

    runs, shared = LineRuns(spark, fanout), None
    for k in range(len(cuts) + 1):
        found = runs.admit(lines.filter(F.col("batch") == k)).filter("owner is null or owner < last")
        found = found.withColumn("batch", F.lit(k))
        shared = found if shared is None else shared.union(found)
    drops = _dropped(lines, shared).groupBy("place", "twin").agg(F.collect_set("pos").alias("__gone"))
    drops = drops.withColumnsRenamed({"place": "__place", "twin": "__twin"})
    own = F.split("__text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size("__own") - 1), "__gone")
    kept = F.array_join(F.transform(left, lambda p: F.get("__own", p)), "\n")
    out = rows.join(drops, ["__place", "__twin"], "left").withColumn("__own", own)
    return out.select(
        F.col(f"`{id_col}`"),
        *(F.col(f"`{c}`") for c in carry),
        F.size("__own").cast("long").alias("n_lines"),
        F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long").alias("n_dropped"),
        F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(kept).alias("kept_text"),
    )


def _dropped(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """Lines that go: those with a shared key, but for the owner's.

    A key of very many lines is not joined by its hash, which would bring all of them to one task. There are at
    most HOT_KEYS of them, for each has at least that share of all lines: their table is broadcast.
    """
    total = lines.count()
    hot = F.col("n") >= max(HOT_LINES, -(-total // HOT_KEYS))
    on = ["batch", *KEY]
    few = F.broadcast(shared.filter(hot).select(*on, "owner"))
    rest = lines.join(few.select(*on), on, "left_anti").join(shared.filter(~hot).select(*on, "owner"), on)
    every = lines.join(few, on).unionByName(rest)
    return every.filter("owner is null or place > owner").select("place", "twin", "pos")
