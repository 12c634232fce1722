"""Very long texts: many words in one line, and one that repeats itself."""

import random

import pytest

from regionpanel.llm.queries import QUERIES

WORDS = 150_000


@pytest.fixture(scope="module")
def long_docs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("long")
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(20_000)]
    once = " ".join(rng.choice(words) for _ in range(WORDS))
    again = " ".join([" ".join(rng.choice(words) for _ in range(300))] * (WORDS // 300))
    short = " ".join(rng.choice(words) for _ in range(200))
    texts = [once, again, once, short, "", None]
    rows = [(i, t, "en", f"s{i % 2}", len(t) if t else None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    item = " ".join(once.split(" ")[70_000:70_060])
    spark.createDataFrame([(1, item), (2, "another question of nine words that nobody has asked")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def by_id(spark, name, sf_dir):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == list(range(6))
    return {r.doc_id: r for r in rows}


def test_sizes_and_pieces(spark, long_docs):
    assert [by_id(spark, "op1_mix_sources", long_docs)[i].size for i in range(6)] == [WORDS, WORDS, WORDS, 200, 0, 0]
    pieces = by_id(spark, "op3_token_counts", long_docs)
    assert pieces[0].n_words == WORDS and pieces[0].n_pieces == pieces[2].n_pieces > WORDS
    shards = by_id(spark, "op7_shard", long_docs)
    assert sorted((shards[i].shard, shards[i].slot) for i in range(6)) == sorted({(shards[i].shard, shards[i].slot) for i in range(6)})


def test_licences_and_rules(spark, long_docs):
    assert {r.license for r in by_id(spark, "op2_license_scan", long_docs).values()} == {None}
    rules = by_id(spark, "op5_quality_rules", long_docs)
    assert rules[0].n_words == WORDS and rules[0].kept and rules[1].base_failed and not rules[1].kept


def test_groups_and_leaks(spark, long_docs):
    groups = by_id(spark, "op9_ngram_jaccard", long_docs)
    assert [groups[i].component_id for i in range(6)] == [0, 1, 0, 3, 4, 5] and groups[1].n_shingles == 300
    assert {r.doc_id for r in QUERIES["op10_benchmark_leaks"](spark, long_docs).collect()} == {0, 2}


def test_infills(spark, long_docs):
    cut = by_id(spark, "op12_fill_in_middle", long_docs)
    assert cut[0].n > 5 * WORDS and cut[0].restored_sha256 == cut[2].restored_sha256
