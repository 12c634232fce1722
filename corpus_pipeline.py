"""A training corpus from raw documents: rules, near duplicates, benchmark leaks, mixture, shards.

Every stage takes the documents the one before has written and returns documents; its rows are what it keeps.

Of nulls, empty and very long texts, ties, repeated rows and empty tables the stages make what their operators say, in short:
a null or empty text fails the rules, so no later stage sees one; of rows alike in id and text, and of similar documents, one
stays; very long texts are looked at whole; an empty table passes all stages and gives no rows; other columns stay.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from regionpanel.llm import decontaminate, mixing, ngram_join, quality, sharding  # noqa: E402
from regionpanel.llm.common import read, settle  # noqa: E402
from regionpanel.llm.queries import weighted_sources  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on repetition; texts of fewer than ten words, null ones included, go."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that with the smallest id; ids that are null come last."""
    return ngram_join.one_of_each_group(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; all of them where there are no items."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: parts of documents as blocks take them, some twice, so that sources weigh 5, 2, 1 in turn.

    A row is the part of one document in one block; text and n_chars are the part's, other columns the document's.
    """
    rows = mixing.sized(docs, carry=True)
    sources = mixing.targets(weighted_sources(rows), share=1.5, most=2.0)
    mixed = mixing.mix(mixing.lay_out(rows), sources, text="text")
    own = {"text": F.col("piece"), "n_chars": F.length("piece").cast("long")}
    return mixed.select(*[own.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in random order, the same in every run: shard and slot. Counts of shards differ by one at most."""
    return sharding.two_pass_shuffle(docs, shards=8)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: Neither suffix arrays nor seeded shuffles can be said in SQL; the tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
