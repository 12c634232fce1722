"""Licence scan, piece counts, quality rules, sharding and line dedup."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from regionpanel.llm import licenses, lines, quality, sharding, tokens
from regionpanel.llm.queries import QUERIES
from regionpanel.llm.sql import SQL
from tests.oracle import compare, connect

from .odd import empty_docs, odd_docs, rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    problem = compare(spark, connect(SF_DIR), name, QUERIES[name], SQL[name], SF_DIR)
    assert not problem, problem


# licences


def test_licence_spellings(spark):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and len(t) > 200)
    texts = {
        1: mit, 2: "Copyright (c) 2020 Somebody\n\n" + mit.upper(), 3: mit.replace("copyright holders", "copyright owners").replace("sublicense", "sub-license").replace(",", " ;"),
        4: mit + " with one word more", 5: "Text.\nreleased under the mit licence!\nText", 6: None, 7: "", 8: " \n ", 9: "Released under the MIT License.",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, licenses.known_licenses(spark)).collect()}
    assert {i: r.license for i, r in got.items()} == {1: "MIT", 2: "MIT", 3: "MIT", 4: None, 5: None, 6: None, 7: None, 8: None, 9: "MIT"}
    assert got[5].line_licenses == "MIT" and got[5].first_line == 1 and got[4].line_licenses == ""
    assert got[1].digest == got[2].digest == got[3].digest and got[6].digest is None and got[8].digest is None


def test_licence_scan_of_odd_tables(spark):
    known = licenses.known_licenses(spark)
    got = licenses.scan(odd_docs(spark), known).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    assert [r.line_licenses for r in got if r.doc_id == 19] == ["MIT"]
    assert licenses.scan(empty_docs(spark), known).count() == 0
    assert licenses.scan(odd_docs(spark), known.limit(0)).filter("license IS NOT NULL").count() == 0


# pieces


def greedy(word: bytes, begin: set[bytes], inside: set[bytes]) -> int:
    n, at, vocabulary = 0, 0, begin
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return 1
        n, at, vocabulary = n + 1, end, inside
    return n


def test_pieces_of_random_vocabularies():
    rng = random.Random(4)
    make = lambda k: bytes(rng.choice(b"ab") for _ in range(rng.randint(1, k)))
    for trial in range(150):
        begin, inside = {make(5) for _ in range(rng.randint(1, 8))}, {make(5) for _ in range(rng.randint(1, 8))}
        auto = tokens.Automaton(sorted(begin), sorted(inside))
        words = [make(30) for _ in range(40)]
        want = [greedy(w, begin, inside) for w in words]
        assert [auto.count_word(w) for w in words] == want
        got = tokens.count_texts(auto, [" ".join(w.decode() for w in words), None, "", words[0].decode()])
        assert got[0].tolist() == [40, 0, 0, 1] and got[1].tolist() == [sum(want), 0, 0, want[0]], trial


def test_pieces_against_the_public_tokenizer(spark):
    from tokenizers import Tokenizer, models

    begin, inside = tokens.word_pieces()
    text = lambda b: b.decode("latin-1")
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys([*map(text, begin), *("##" + text(b) for b in inside), "[UNK]"]))}
    model = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10**9))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").limit(40)
    got = {r.doc_id: (r.n_words, r.n_pieces) for r in tokens.token_counts(docs).collect()}
    for r in docs.collect():
        words = r.text.encode().split()
        assert got[r.doc_id] == (len(words), sum(len(model.encode(text(w), add_special_tokens=False).ids) for w in words))


def test_pieces_of_odd_tables(spark):
    got = tokens.token_counts(odd_docs(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    begin, inside = map(set, tokens.word_pieces())
    assert {r.n_pieces for r in got if r.doc_id == 15} == {greedy("é".encode() * 300, begin, inside)}
    assert all(r.n_words == r.n_pieces == 0 for r in got if r.doc_id in (8, 9, 10))
    assert tokens.token_counts(empty_docs(spark)).count() == 0


# quality


def brute_repeats(words: list, least: int) -> tuple[int, int]:
    """Words covered by substrings of at least ``least`` words that occur twice, and the longest repeat."""
    covered, longest = set(), 0
    for i in range(len(words)):
        for j in range(i):
            k = 0
            while i + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
            if k >= least:
                covered.update(range(i, i + k), range(j, j + k))
    return len(covered), longest


def test_repeats_against_brute_force():
    rng = random.Random(8)
    docs = [[bytes([rng.choice(b"abc")]) for _ in range(rng.randint(0, 90))] for _ in range(80)]
    docs += [[b"x"] * 70, [b"x", b"y"] * 40, []]
    got = quality.repetition(docs)
    for d, (five, long, longest) in zip(docs, got.tolist(), strict=True):
        assert five == brute_repeats(d, quality.WINDOW)[0]
        assert (long, longest) == brute_repeats(d, quality.REPEAT_WORDS)


def test_one_array_or_many(monkeypatch):
    rng = np.random.default_rng(1)
    docs = [[bytes([97 + x]) for x in rng.integers(0, 3, n)] for n in (50, 3, 0, 200, 70)]
    whole = quality.repetition(docs)
    monkeypatch.setattr(quality, "ARRAY_WORDS", 60)
    assert (quality.repetition(docs) == whole).all()


def test_quality_of_odd_tables(spark):
    got = quality.quality(odd_docs(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    by = {r.doc_id: r for r in got}
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (8, 9, 10, 11, 12, 13))
    assert by[0].kept and by[14].kept and not by[17].kept and by[17].n_dup_lines == 4
    docs = odd_docs(spark)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert quality.quality(empty_docs(spark)).count() == 0


# sharding


def check_shards(got, shards):
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    counts = [len(places[s]) for s in range(shards)]
    assert sum(counts) == len(got) and max(counts) - min(counts) <= 1
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards_of_the_query(spark):
    got = QUERIES["op7_shard"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    check_shards(got, 8)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw) and r.law == "rows" and r.grown_shard is None
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert Counter(got) == Counter(QUERIES["op7_shard"](spark, SF_DIR).collect())
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    ups = sum(a < b for a, b in zip(order, order[1:]))
    assert 0.3 * len(order) < ups < 0.7 * len(order)


@pytest.mark.parametrize("bucket_bytes", [300, 10**9])
def test_shards_of_odd_tables(spark, bucket_bytes):
    docs = odd_docs(spark)
    out = sharding.two_pass_shuffle(docs, shards=3, bucket_bytes=bucket_bytes)
    check_shards(out.select("shard", "slot").collect(), 3)
    assert set(out.columns) == set(docs.columns)
    assert Counter(map(tuple, out.select("doc_id", "text").collect())) == Counter((r[0], r[1]) for r in rows())
    assert sharding.two_pass_shuffle(empty_docs(spark), shards=3).count() == 0


# lines


def brute_lines(docs, least=lines.MIN_LINES, chars=lines.MIN_CHARS):
    """Lines kept of every distinct (id, text), by comparing all runs of all lengths."""
    first, held = {}, {}
    keys = sorted({(r[0], r[1]) for r in docs}, key=lambda k: (k[0] is not None, k[0] or 0))
    for key in keys:
        held[key] = [(i, x) for i, x in enumerate((key[1] or "").split("\n")) if x.encode().split()]
    once = Counter(x for seq in held.values() for _, x in seq)
    out = {}
    for key in keys:
        seq = held[key]
        gone = set()
        for at in range(len(seq)):
            for end in range(at + 1, len(seq) + 1):
                if once[seq[end - 1][1]] < 2:
                    break
                run = tuple(x for _, x in seq[at:end])
                if len(run) >= least and sum(map(len, run)) >= chars and first.setdefault(run, (key, at)) != (key, at):
                    gone.update(range(at, end))
        drop = {seq[at][0] for at in gone}
        out[key] = None if key[1] is None else "\n".join(x for i, x in enumerate(key[1].split("\n")) if i not in drop)
    return out


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_lines_of_odd_tables(spark, least):
    docs = odd_docs(spark)
    got = lines.dedup_lines(docs, min_lines=least, min_chars=20)
    # One id stands for two texts; their order is that of their hashes, so brute force leaves them out.
    data = [r for r in rows() if not (r[0] == 3 and r[1].startswith("same"))]
    want = brute_lines(data, least, 20)
    kept = {}
    for r in got.select("doc_id", "text").collect():
        kept.setdefault(r.doc_id, []).append(r.text)
    for (i, text), left in want.items():
        assert left in kept[i], (i, text)
    assert got.count() == len(rows()) and set(docs.columns) <= set(got.columns) | {"removed"}
    assert lines.dedup_lines(empty_docs(spark)).count() == 0


def test_lines_of_random_runs(spark):
    rng = random.Random(6)
    pool = ["a" * n for n in (1, 2, 5, 9, 30)] + ["b" * 7, "c d", "e" * 12]
    data = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))) for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    for least, chars in ((1, 10), (1, 40), (3, 12)):
        want = brute_lines(data, least, chars)
        got = {r.doc_id: r.text for r in lines.dedup_lines(docs, min_lines=least, min_chars=chars).collect()}
        assert got == {i: left for (i, _), left in want.items()}, (least, chars)


def test_a_long_line_between_different_neighbours_goes(spark):
    long = "word " * 80
    docs = spark.createDataFrame([(i, f"before {i}\n{long}\nafter {i}") for i in range(10)], "doc_id long, text string")
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert [got[i].removed for i in range(10)] == [0] + [1] * 9
    assert got[5].text == "before 5\nafter 5"


def test_a_very_long_text_that_repeats_itself(spark):
    unit = "\n".join(f"line {i} " + "x" * (i % 40) for i in range(500))
    docs = spark.createDataFrame([(1, "\n".join([unit] * 40)), (2, unit), (3, "\n".join(["y"] * 30_000))], "doc_id long, text string")
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert got[1].text == unit and got[1].removed == 39 * 500 and got[2].removed == 500
    # A hundred times the same line is a run; the later ones go as far as such a run occurs earlier.
    assert got[3].text == "y" and got[3].removed == 29_999


def test_lines_plan_is_native(spark):
    plan = QUERIES["op8_line_dedup"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_crc_of_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("é",)], "t string").select(sharding.crc(F.col("t")).alias("c"))
    assert [r.c for r in df.collect()] == [None, 0, zlib.crc32("é".encode())]
