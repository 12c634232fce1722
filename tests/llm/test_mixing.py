from collections import Counter

import pytest
from pyspark.sql import functions as F

from regionpanel.llm import mixing
from regionpanel.llm.queries import QUERIES, weighted_sources

from .odd import empty_docs, odd_docs, rows


def filled(caps: dict, weights: dict, total: float) -> dict:
    """Reshare the excess until no target is above its cap."""
    done = {}
    while True:
        free = [s for s in caps if s not in done]
        level = (total - sum(done.values())) / sum(weights[s] for s in free)
        over = [s for s in free if level * weights[s] >= caps[s]]
        if not over:
            return done | {s: level * weights[s] for s in free}
        done |= {s: caps[s] for s in over}
        if len(done) == len(caps):
            return done


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_keeps_the_contract(spark, sf):
    got = QUERIES["op1_mix_sources"](spark, f"/root/testdata/sf{sf}").collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    sizes, taken = Counter(), Counter()
    for r in got:
        assert r["size"] == len((docs[r.doc_id].text or "").encode().split())
        assert 0 <= r.taken <= 2 * r["size"]
        sizes[docs[r.doc_id].source] += r["size"]
        taken[docs[r.doc_id].source] += r.taken
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want = filled({s: 2.0 * sizes[s] for s in names}, weights, 1.5 * sum(sizes.values()))
    for r in got:
        assert r.source_size == sizes[docs[r.doc_id].source]
        assert r.target == pytest.approx(want[docs[r.doc_id].source], abs=1e-5)
    for s in names:
        assert abs(taken[s] - want[s]) <= 1
    again = QUERIES["op1_mix_sources"](spark, f"/root/testdata/sf{sf}").collect()
    assert Counter(again) == Counter(got)


def mixed(spark, docs, text=None, **sizes):
    rows = mixing.sized(docs, carry=text is not None)
    sources = mixing.targets(weighted_sources(rows), share=1.5, most=2.0)
    return sources, mixing.mix(mixing.lay_out(rows, chunk_rows=5), sources, text, **sizes)


def test_blocks_shards_and_text(spark):
    docs = odd_docs(spark)
    sources, out = mixed(spark, docs, "text", block_words=64, shard_slots=7, seed=3)
    got = out.select("out_shard", "slot", "source_key", "block", "in_block", "start", "words", "piece", "doc.doc_id", "text_hash").collect()
    texts = {}
    for r in docs.select("doc_id", mixing.row_hash(F.col("text")).alias("h"), "text").collect():
        texts[r.doc_id, r.h] = (r.text or "").encode().split()
    for r in got:
        assert r.piece.encode().split() == texts[r.doc_id, r.text_hash][r.start : r.start + r.words]
        assert r.in_block + r.words <= 64
    # A slot holds one block of one source; slots of a shard are numbered without gaps but in the last shard.
    slots = {(r.out_shard, r.slot): (r.source_key, r.block) for r in got}
    assert len(slots) == len({(r.out_shard, r.slot, r.source_key, r.block) for r in got})
    full = Counter(s for s, _ in slots)
    assert all(full[s] == 7 for s in range(max(full)))
    taken = Counter()
    for r in got:
        taken[r.source_key] += r.words
    for s in sources.collect():
        assert abs(taken[s.source_key] - s.target) <= 1
    # Shards differ in what they hold of a source, as draws do.
    assert len({tuple(sorted(Counter(v[0] for k, v in slots.items() if k[0] == s).items())) for s in range(max(full))}) > 1


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 64, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), 5, F.lit("s"), F.lit(0)).alias("p"), mixing.permuted(F.col("id"), F.lit(n), 5, F.lit("s"), F.lit(1)).alias("q"))
        got = df.collect()
        assert sorted(r.p for r in got) == list(range(n)) == sorted(r.q for r in got)
        assert n < 64 or ([r.p for r in got] != [r.q for r in got] and [r.p for r in got] != list(range(n)))


def test_empty_and_wordless_tables(spark):
    assert mixed(spark, empty_docs(spark))[1].count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    sources, out = mixed(spark, blank)
    assert out.count() == 0 and [r.target for r in sources.collect()] == [0.0, 0.0]


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op1_mix_sources"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and len(rows()) > 0
