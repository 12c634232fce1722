"""Benchmark leaks against plain BM25 over all passages, and the pipeline stage by stage."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from regionpanel.llm import decontaminate, quality
from regionpanel.llm.queries import QUERIES

from .odd import CLASHES, empty_docs, odd_docs, prose, rows
from .test_repeats import shingle_set

SF_DIR = "/root/testdata/sf0.001"
ITEMS = "item_id long, text string"


def plain_bm25(items: list[tuple], words: list[str]) -> dict[int, float]:
    """Score of every item for all distinct terms of a passage, as a share of the item's own score."""
    bags = [Counter(decontaminate.terms(t or "")) for _, t in items]
    bags = [b for b in bags if b]
    mean = sum(sum(b.values()) for b in bags) / len(bags)
    df = Counter(t for b in bags for t in b)
    out = {}
    for i, (_, t) in enumerate(items):
        b = Counter(decontaminate.terms(t or ""))
        if b:
            norm = decontaminate.K1 * (1 - decontaminate.B + decontaminate.B * sum(b.values()) / mean)
            one = {x: math.log(1 + (len(bags) - df[x] + 0.5) / (df[x] + 0.5)) * f * (decontaminate.K1 + 1) / (f + norm) for x, f in b.items()}
            out[i] = sum(one[x] for x in set(words) & set(one)) / sum(one.values())
    return out


def brute_leaks(items: list[tuple], text: str) -> dict[int, float]:
    words, longest = decontaminate.terms(text or ""), max(len(decontaminate.terms(t or "")) for _, t in items)
    found = {}
    for start in range(0, max(len(words), 1), longest):
        passage = words[start : start + 2 * longest]
        for i, score in plain_bm25(items, passage).items():
            if score < decontaminate.THRESHOLD - 1e-9:
                continue
            parts = [decontaminate.grams(p) for p in decontaminate.question_answer(items[i][1])]
            here = [{tuple(passage[j : j + len(g)]) for g in p for j in range(len(passage) - len(g) + 1)} for p in parts]
            if all(100 * len(p & h) >= decontaminate.OVERLAP * len(p) for p, h in zip(parts, here, strict=True)):
                found[i] = max(found.get(i, 0), score)
    return found


def planted() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(1)
    small = ["ab", "cd", "ef", "gh", "ij", "kl", "mn", "of", "the", "on"]
    prose_of = lambda n: " ".join(rng.choice(small) + rng.choice(["", *small]) for _ in range(n))
    items = [(i, f"{prose_of(rng.randint(8, 30))}. {prose_of(rng.randint(1, 8))}.") for i in range(30)]
    items += [(40, prose_of(12)), (41, "one"), (42, None), (43, ""), (44, items[0][1]), (None, prose_of(20) + ". yes.")]
    docs = []
    for i in range(60):
        text = prose_of(rng.randint(0, 150))
        item = items[rng.randrange(len(items))][1] or ""
        cut = item.split(" ")
        hidden = [item, item.upper(), " ".join(cut[: len(cut) // 2]), item.replace(" ", "\n"), " ".join(w if rng.random() < 0.9 else "zz" for w in cut)][i % 5]
        docs.append((i, text + " " + hidden + " " + prose_of(rng.randint(0, 150))))
    return items, docs


@pytest.mark.parametrize("common", [decontaminate.COMMON, 0.0, 1.0])
def test_finds_are_those_of_plain_bm25(common, monkeypatch):
    monkeypatch.setattr(decontaminate, "COMMON", common)
    items, docs = planted()
    index = decontaminate.Index([i for i, _ in items], [t for _, t in items])
    got = [set() for _ in docs]
    for d, item, score, *_ in index.scan([t for _, t in docs]):
        got[d].add((index.ids[item], round(score, 9)))
    want = [{(items[i][0], round(s, 9)) for i, s in brute_leaks(items, t).items()} for _, t in docs]
    assert got == want and sum(map(len, want)) > 30


def test_several_indexes_give_the_same_documents(spark, monkeypatch):
    items, docs = planted()
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    one = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "INDEX_ITEMS", 12)
    monkeypatch.setattr(decontaminate, "THRESHOLD", 0.5)  # scores depend on the other items of an index
    several = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    assert one <= several
    left = {r.doc_id for r in decontaminate.clean(docs, items).collect()}
    assert left == {r.doc_id for r in docs.collect()} - {d for d, _ in several}


def test_leaks_of_the_query(spark):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_benchmark_leaks"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    whole = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    assert whole <= got and len(whole) > 0
    texts = {i.item_id: shingle_set(" ".join(decontaminate.terms(i.text))) for i in items}
    words = {d.doc_id: shingle_set(" ".join(decontaminate.terms(d.text))) for d in docs}
    assert all(2 * len(texts[i] & words[d]) >= len(texts[i]) for d, i in got)


def test_items_with_an_edited_or_cut_answer_are_found(spark):
    question = prose(31, 20)
    items = [(1, f"{question}. {prose(32, 6)}."), (2, f"{prose(33, 20)}. yes."), (3, f"{prose(34, 12)}. {prose(35, 4)}."), (4, prose(36, 30))]
    w = [t.split(" ") for _, t in items]
    texts = [
        " ".join([*w[0][:22], "zz", *w[0][23:]]),  # a word of the last sentence changed
        " ".join(w[1][:-1]),  # the last sentence cut off
        " ".join([*w[2][:13], "zz", *w[2][14:]]),  # one of four words changed
        " ".join([*w[3][:28], "zz", w[3][29]]),  # a word of the last quarter changed
        " ".join(w[0][:6]) + " " + prose(37, 20),
    ]
    docs = [(i, prose(40 + i, 50) + " " + t + " " + prose(50 + i, 50)) for i, t in enumerate(texts)]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()} == {(0, 1), (1, 2), (2, 3), (3, 4)}
    assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == {4}


def test_leaks_of_odd_tables(spark):
    docs, items = odd_docs(spark), spark.createDataFrame([(1, prose(3, 60)), (2, "nothing like it at all"), (3, None)], ITEMS)
    got = decontaminate.leaks(docs, items).collect()
    assert Counter(r.doc_id for r in got) == Counter({5: 1, 6: 1, 7: 1}) and {r.item_id for r in got} == {1}
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(rows()) - 3
    assert decontaminate.leaks(empty_docs(spark), items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == len(rows())


# pipeline


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "benchmark_leaks", "mix_sources", "shard"]
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        made[name] = (before.collect(), docs.collect())
        assert docs.columns[: len(before.columns)] == before.columns
    before, after = made["quality_rules"]
    verdict = quality.measure([r.text for r in before])["kept"]
    assert Counter(after) == Counter(r for r, k in zip(before, verdict, strict=True) if k)

    before, after = made["near_duplicates"]
    sets = {r.doc_id: shingle_set(r.text) for r in before}
    stays = {r.doc_id for r in after}
    similar = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    assert not any(similar(a, b) for a in stays for b in stays if a < b)
    assert set(after) <= set(before) and len(after) == len(stays) < len(before)
    # Every document that went has a similar one that is smaller or went itself.
    assert all(any(similar(a, b) for b in sets if b != a) for a in sets if a not in stays)

    before, after = made["benchmark_leaks"]
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert set(after) <= set(before) and not any(i in r.text for r in after for i in items)
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone >= {r.doc_id for r in before if any(i in r.text for i in items)}

    before, after = made["mix_sources"]
    words, texts = Counter(), {r.doc_id: r for r in before}
    for r in after:
        own = texts[r.doc_id]
        assert r.text in own.text and (r.lang, r.source, r.n_chars) == (own.lang, own.source, len(r.text))
        words[r.doc_id] += len(r.text.encode().split())
    assert all(n <= 2 * len(texts[d].text.encode().split()) for d, n in words.items())
    assert sum(words.values()) == pytest.approx(1.5 * sum(len(r.text.encode().split()) for r in before), abs=20)

    before, after = made["shard"]
    assert Counter(tuple(r)[:-2] for r in after) == Counter(map(tuple, before))
    counts = Counter(r.shard for r in after)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    docs = odd_docs(spark).drop("shard", "slot")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty_docs(spark), SF_DIR)
        assert empty.count() == 0
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns + (["shard", "slot"] if name == "shard" else [])
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.count() > 0 and set(CLASHES) - {"shard", "slot"} <= set(docs.columns)
    assert docs.filter(F.col("key") != "clash").count() == 0


def test_entry_registers_the_text_queries():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
