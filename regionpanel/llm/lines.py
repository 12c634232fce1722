"""Delete later copies of line runs, by a suffix array over line ids with distributed prefix doubling.

Only DataFrame functions run here. A document is the sequence of its lines that hold a word. The rank of a suffix
by its first line is the place of the earliest suffix that begins with the same line; its rank by twice as many lines
comes from the pair (own rank, rank that many lines further on). Suffixes of the same rank are an interval of the
suffix array whose common prefix has that length; all but the earliest of them are copies.

A repeated run of any number of lines, one included, goes if it has ``min_lines`` lines and ``min_chars`` characters. Such
a run is covered by the shortest runs in it that have both, counted from each line forwards and backwards; where these end
follows from the lines alone, so copies have them at the same places. The ranks of a shortest run's first and last 2 ** k
lines, which overlap, tell it from others. Doubling goes on until the longest of them is covered. What the copies cover,
joined, are the maximal repeated runs.

Defined results: lines without a word belong to no run and stay; "earlier" is a smaller document id, then the smaller
text hash, then the earlier line; null ids come first; rows alike in id and text are decided alike, by
one of them; a null text has no lines and stays null; a text whose lines all go becomes empty; very long texts are rows
of lines like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import row_hash, settle

MIN_LINES = 1
MIN_CHARS = 100


def line_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` (id, text hash), ``line`` (place in the text), ``at`` (place among lines with a word), ``id``, ``chars``."""
    rows = docs.select(F.struct(F.col(doc_id).alias("doc_id"), row_hash(F.col(text)).alias("text_hash")).alias("doc"), F.col(text).alias("text"))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("value")))
    lines = F.filter(lines, lambda x: x["value"].rlike(r"[^\x20\x09-\x0D]"))
    one = lambda x, i: F.struct(
        x["line"].alias("line"), i.alias("at"), F.xxhash64(x["value"]).alias("id"), F.md5(x["value"]).alias("id2"), F.length(x["value"]).alias("chars")
    )
    rows = rows.select("doc", F.explode(F.transform(lines, one)).alias("x"))
    # Rows alike in id and text give the same lines; one of each is enough.
    return rows.select("doc", "x.line", "x.at", F.struct("x.id", F.substring("x.id2", 1, 8).alias("more")).alias("id"), "x.chars").dropDuplicates(["doc", "at"])


def ranked(rows: DataFrame, key: str) -> DataFrame:
    """``rank`` of every suffix that shares ``key`` with another one: the earliest of them.

    The earliest place is a grouping with partial sums, so a line that most documents have is one row per task. The
    table of repeated keys then meets the suffixes in an ordinary join, whose hot keys Spark splits.
    """
    first = rows.groupBy(key).agg(F.min(F.struct("doc", "at")).alias("rank"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1").drop("n")
    return rows.join(first, key).drop(key)


def shortest_runs(repeated: DataFrame, min_lines: int, min_chars: int) -> DataFrame:
    """``doc``, ``at`` and ``lines`` of the shortest runs of repeated lines that have enough lines and characters.

    In a stretch of repeated lines a run from one line to another has enough characters if the characters up to its end
    are as many as those before its beginning and ``min_chars``. On one axis of both numbers, the run that begins at a line
    ends with the next end, and the run that ends at a line begins with the beginning before it.
    """
    stretch = Window.partitionBy("doc").orderBy("at")
    rows = repeated.select("doc", "at", "chars", (F.col("at") - F.row_number().over(stretch)).alias("stretch"))
    inside = Window.partitionBy("doc", "stretch")
    rows = rows.withColumns({"upto": F.sum("chars").over(inside.orderBy("at")), "all": F.sum("chars").over(inside)})
    rows = rows.filter(F.col("all") >= min_chars)
    ends = F.struct(F.col("upto").alias("place"), F.lit(1).alias("end"), F.col("at"))
    begins = F.struct((F.col("upto") - F.col("chars") + min_chars).alias("place"), F.lit(0).alias("end"), F.col("at"))
    axis = rows.select("doc", "stretch", F.explode(F.array(begins, ends)).alias("x")).select("doc", "stretch", "x.*")
    along = [F.col("place"), F.col("end")]
    so_far = inside.orderBy(*along).rowsBetween(Window.unboundedPreceding, 0)
    to_come = inside.orderBy(*[c.desc() for c in along]).rowsBetween(Window.unboundedPreceding, 0)
    axis = axis.withColumn("begin", F.max(F.when(F.col("end") == 0, F.col("at"))).over(so_far))
    axis = axis.withColumn("finish", F.min(F.when(F.col("end") == 1, F.col("at"))).over(to_come))
    lowest, highest = F.min("at").over(inside), F.max("at").over(inside)
    axis = axis.withColumns({"lowest": lowest, "highest": highest})
    # As many lines as are asked for, if the stretch has them.
    first = F.when(F.col("end") == 1, F.least("begin", F.col("at") - (min_lines - 1))).otherwise(F.col("at"))
    last = F.when(F.col("end") == 0, F.greatest("finish", F.col("at") + (min_lines - 1))).otherwise(F.col("at"))
    # Without another end or beginning the characters are too few.
    axis = axis.filter(F.when(F.col("end") == 1, F.col("begin")).otherwise(F.col("finish")).isNotNull())
    runs = axis.select("doc", first.alias("at"), last.alias("last"), "lowest", "highest")
    runs = runs.filter((F.col("at") >= F.col("lowest")) & (F.col("last") <= F.col("highest")))
    return runs.select("doc", "at", (F.col("last") - F.col("at") + 1).alias("lines")).distinct()


def copied_runs(lines: DataFrame, min_lines: int, min_chars: int) -> DataFrame:
    """``doc``, ``at`` and ``lines`` of the shortest runs that occur earlier as well."""
    ranks = settle(ranked(lines.select("doc", "at", "chars", "id"), "id"), "line-ranks")
    runs = settle(shortest_runs(ranks, min_lines, min_chars), "line-runs")
    longest = runs.agg(F.max("lines")).first()[0] or 0
    place, own = F.struct("doc", "at"), ["doc", "at", "lines"]
    copies, width = runs.filter("false"), 1
    ranks = ranks.drop("chars")
    while width <= longest:
        # A run of ``width`` lines has its rank; a longer one, of less than twice as many, that of its first and last lines.
        found = runs.filter(F.col("lines") == width).join(ranks, ["doc", "at"]).filter(F.col("rank") != place).select(*own)
        if longest > width:
            some = runs.filter((F.col("lines") > width) & (F.col("lines") < 2 * width))
            tails = ranks.select("doc", F.col("at").alias("tail"), F.col("rank").alias("next"))
            keyed = some.withColumn("tail", F.col("at") + F.col("lines") - width).join(ranks, ["doc", "at"]).join(tails, ["doc", "tail"])
            keyed = keyed.select(*own, F.struct("lines", "rank", "next").alias("key"))
            found = found.unionByName(ranked(keyed, "key").filter(F.col("rank") != place).select(*own))
            after = ranks.select("doc", (F.col("at") - width).alias("at"), F.col("rank").alias("next"))
            pairs = ranks.join(after, ["doc", "at"]).withColumn("key", F.struct("rank", "next")).drop("rank", "next")
            ranks = settle(ranked(pairs, "key"), "line-ranks")
        # Stored, so that the plan does not grow with the rounds.
        copies = copies.unionByName(settle(found, "line-copies"))
        width *= 2
    return copies


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc``, ``line``, ``run`` of every line that is deleted."""
    lines = settle(line_ids(docs, doc_id, text), "lines")
    copies = copied_runs(lines, max(min_lines, 1), min_chars)
    gone = copies.select("doc", F.explode(F.sequence("at", F.col("at") + F.col("lines") - 1)).alias("at")).distinct()
    gone = gone.join(lines.select("doc", "at", "line"), ["doc", "at"])
    order = Window.partitionBy("doc").orderBy("at")
    return gone.select("doc", "line", (F.col("at") - F.row_number().over(order)).alias("run"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the text that is left and ``removed``, ``runs``; columns of these two names give way."""
    gone = removed_lines(docs, doc_id, text, min_lines, min_chars)
    gone = gone.groupBy("doc").agg(F.collect_set("line").alias("_gone"), F.countDistinct("run").alias("runs"))
    gone = gone.select(F.col("doc.doc_id").alias("_id"), F.col("doc.text_hash").alias("_hash"), "_gone", "runs")
    docs = docs.drop("removed", "runs").withColumn("_of", row_hash(F.col(text)))
    out = docs.join(gone, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_hash")), "left")
    kept = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains("_gone", i))
    out = out.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
    out = out.withColumn("removed", F.coalesce(F.size("_gone"), F.lit(0)).cast("long"))
    out = out.withColumn("removed", F.greatest("removed", F.lit(0))).withColumn("runs", F.coalesce("runs", F.lit(0)))
    return out.select(*[c for c in docs.columns if c != "_of"], "removed", "runs")
