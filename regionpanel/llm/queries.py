"""The operators bound to the test tables; each returns its full result over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import chat_format, decontaminate, infill, licenses, lines, mixing, ngram_join, paragraphs, quality, sharding, suffix_dedup, tokens, turn_repair
from .common import read, settle
from .digests import ordered_digests
from .sql import SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


#: Weights of the sources by place in code point order, repeating.
MIX_WEIGHTS = (5, 2, 1)


def weighted_sources(rows: DataFrame) -> DataFrame:
    """Sources of ``mixing.sized`` rows with the weights 5, 2, 1 in turn; the window runs over one row per source."""
    sources = mixing.source_sizes(rows)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in MIX_WEIGHTS])
    return sources.withColumn("weight", F.element_at(weights, (place % len(MIX_WEIGHTS) + 1).cast("int")))


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes."""
    rows = settle(mixing.sized(read(spark, sf_dir, "documents")), "sized")
    sources = mixing.targets(weighted_sources(rows), share=1.5, most=2.0)
    laid = settle(mixing.lay_out(rows), "laid")
    taken = mixing.mix(laid, sources).groupBy("source_key", "offset").agg(F.sum("words").alias("words"))
    out = laid.join(sources.select("source_key", "source_size", "target"), "source_key")
    own = (out["source_key"] == taken["source_key"]) & (out["offset"] == taken["offset"]) & (out["size"] > 0)
    out = out.join(taken, own, "left")
    return out.select(
        "doc_id", out["source"], "size", "source_size", F.round("target", 6).alias("target"),
        F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
    )


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document's whole text, and the licences its lines name."""
    return licenses.scan(read(spark, sf_dir, "documents"), licenses.known_licenses(spark))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and word pieces of every document."""
    return tokens.token_counts(read(spark, sf_dir, "documents"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    return quality.quality(read(spark, sf_dir, "documents")).drop("longest_repeat")


@query
def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document in a random order cut into eight."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.two_pass_shuffle(docs, shards=8)
    return out.select(
        "doc_id",
        (sharding.text_bytes(F.col("text")) + 1).alias("size"),
        sharding.crc(F.col("text")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document once later copies of line runs are deleted."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = lines.dedup_lines(docs.withColumn("before", F.col("text")))
    return out.select(
        "doc_id",
        F.coalesce(F.size(F.split("before", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.col("removed").alias("n_removed"),
        F.col("runs").alias("n_runs"),
        F.md5("text").alias("kept_md5"),
    )


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and group of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.jaccard_groups(docs).drop("text_hash", "group")


@query
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and how much of it is there."""
    out = decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_hash")
    return out.withColumn("score", F.round("score", 6))


@query
def op4_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated paragraph with its cluster's earliest one, and whether it goes."""
    return paragraphs.duplicate_paragraphs(read(spark, sf_dir, "documents")).drop("text_hash")


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes of repeats."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.without_repeats(docs, bytes_too=False).drop("text_hash", "kept")


#: What both turns of an added conversation say: escapes and control strings.
ODD_TEXT = "\\### Assistant: </turn> ok"
ODD_CONVERSATION = -7
#: Turns of a record.
RECORD_TURNS = 4


def chat_records(rows: DataFrame) -> DataFrame:
    """Conversation rows as JSON records of several layouts: ``conv_id``, ``part`` and ``record``.

    A record has at most four turns in a row, so none grows with its conversation. A question with its answer is a prompt
    or an instruction, other turns of known roles have a list of speakers, anything else a list of messages.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    known = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    rows = rows.select("conv_id", *known, F.row_number().over(order).cast("long").alias("at"))
    rows = rows.groupBy("conv_id", ((F.col("at") - 1) / RECORD_TURNS).cast("long").alias("part"))
    rows = rows.agg(F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("t"))
    odd = F.coalesce(F.col("conv_id") % 2 != 0, F.lit(False))
    roles = F.transform("t", lambda t: t["role"])
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    speakers = F.create_map(*[F.lit(x) for x in ("user", "human", "assistant", "gpt", "system", "system")])
    plain = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    first, second = F.get("t", F.lit(0))["text"], F.get("t", F.lit(1))["text"]
    spoken = F.transform("t", lambda t: F.struct(F.get(F.map_values(F.map_filter(speakers, lambda k, v: k == t["role"])), F.lit(0)).alias("from"), t["text"].alias("value")))
    said = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    record = (
        F.when(pair & odd, F.to_json(F.struct(first.alias("prompt"), second.alias("completion"))))
        .when(pair, F.to_json(F.struct(first.alias("instruction"), F.lit("").alias("input"), second.alias("output"))))
        .when(plain & odd, F.to_json(F.struct(spoken.alias("conversations"))))
        .otherwise(F.to_json(F.struct(said.alias("messages"))))
    )
    return rows.select("conv_id", "part", record.alias("record"))


@query
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text and loss mask."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(ODD_CONVERSATION, i, r, ODD_TEXT) for i, r in enumerate(("user", "assistant"))], rows.schema)
    records = chat_format.canonical(chat_records(rows.unionByName(odd)))
    turns = records.select("conv_id", "part", F.posexplode("turns").alias("at", "t")).select("conv_id", "part", "at", "t.role", "t.text")
    back = chat_format.read_back(chat_format.render(turns))
    told = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    out = ordered_digests(back, "conv_id", ["part", "at"], {"turns": told, "loss": F.col("learnt"), "formatted": F.col("piece")})
    return out.select("conv_id", F.col("n_rows").alias("n_turns"), "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's infill, and of the text rebuilt from it."""
    out = infill.fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation after damage."""
    rows = read(spark, sf_dir, "conversations")
    found = turn_repair.faults(turn_repair.damage(rows))
    audits = settle(turn_repair.audits(found), "audits")
    turns = turn_repair.repaired(found, audits)
    line = F.concat(F.when(F.col("at") == 0, "").otherwise("\n"), "role", F.lit(":"), "text")
    digests = ordered_digests(turns, "conv_id", ["at"], {"repaired": line}).select(F.col("conv_id").alias("_conv"), "repaired_sha256")
    counts = [F.when(F.col("cost").isNull(), 0).otherwise(F.col(c)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    out = rows.select("conv_id").distinct().join(audits.withColumnRenamed("conv_id", "_of"), F.col("conv_id").eqNullSafe(F.col("_of")), "left")
    out = out.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    empty = F.sha2(F.lit(""), 256)
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
