"""Jaccard groups, paragraph dedup and suffix dedup against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from regionpanel.llm import ngram_join, paragraphs, suffix_dedup
from regionpanel.llm.queries import QUERIES

from .odd import SCHEMA, edited, empty_docs, odd_docs, prose, rows

SF_DIR = "/root/testdata/sf0.001"

# Jaccard groups


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_groups(data, percent=75):
    """Smallest id of the group of every row, by comparing all sets that share a shingle."""
    sets = [shingle_set(t) for _, t in data]
    having = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            having[x].append(i)
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for pair in {(a, b) for members in having.values() for a in members for b in members if a < b}:
        a, b = (sets[i] for i in pair)
        if 100 * len(a & b) >= percent * len(a | b):
            parent[find(pair[0])] = find(pair[1])
    least = {}
    for i, (doc, _) in enumerate(data):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return Counter((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(data))


def groups_of(spark, data, **options):
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_groups(df, **options).collect())


def test_groups_of_the_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op9_ngram_jaccard"](spark, SF_DIR).collect())
    assert got == brute_groups([tuple(r) for r in docs])


def test_chains_families_and_common_passages(spark, monkeypatch):
    rng = random.Random(2)
    texts = []
    for family in range(4):
        base = prose(100 + family, 100)
        texts += [edited(base, rng.randrange(10**6), rng.randint(0, 9)) for _ in range(25)]
    passage = prose(200, 60)
    texts += [prose(300 + i, rng.randint(5, 40)) + " " + passage for i in range(25)]
    data = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(data)
    want = brute_groups(data)
    assert len({c for _, _, c in want}) > 10
    assert groups_of(spark, data) == want
    monkeypatch.setattr(ngram_join, "LEADER_ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "MOST_MATCHES", 2)
    assert groups_of(spark, data, ranges=3) == want


def test_groups_of_odd_tables(spark):
    docs = odd_docs(spark)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_groups(docs).collect())
    want = brute_groups([(r[0], r[1]) for r in rows()])
    # Sets without a token are groups of their own, so a null id stays without one.
    assert got == want
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    left = Counter(r.doc_id for r in kept.collect())
    assert left == Counter({0: 1, 3: 2, 4: 1, 5: 1, 6: 1, 7: 1, 8: 2, 9: 1, 10: 1, 11: 1, 12: 1, 13: 1, 14: 1, 15: 1, 16: 1, 18: 1, 19: 1, 20: 1, 21: 1, None: 1})
    assert ngram_join.jaccard_groups(empty_docs(spark)).count() == 0
    assert ngram_join.one_of_each_group(empty_docs(spark)).count() == 0


def test_chunks_of_any_size_agree(spark):
    texts = [t for _, t, *_ in rows()]
    c = ngram_join.Chunk(texts)
    assert c.df.sum() == len(c.places) == c.size.sum()
    for i, t in enumerate(texts):
        assert c.doc_size[i] == len(shingle_set(t))
        if c.of[i] >= 0:
            own = c.places[c.first[c.of[i]] : c.first[c.of[i] + 1]]
            assert (np.diff(own) > 0).all() and len(own) == c.doc_size[i]


# paragraphs


def test_window_minima():
    rng = np.random.default_rng(3)
    for width in (1, 2, 3, 7, 16, 23):
        counts = rng.integers(0, 60, 12)
        x = rng.integers(0, 30, counts.sum()).astype(np.uint64)
        ends = np.repeat(np.cumsum(counts), counts)
        want, at = set(), 0
        for n in counts:
            for i in range(max(n - width + 1, min(n, 1))):
                part = x[at + i : at + min(i + width, n)]
                want.add(at + i + int(part.argmin()))
            at += n
        assert paragraphs.window_minima(x, ends, width).tolist() == sorted(want)


def test_every_string_has_one_anchor_and_equal_strings_the_same(monkeypatch):
    rng = random.Random(11)
    some = lambda n: bytes(rng.choice(b"ab cd") for _ in range(n))
    for block in (64, 1 << 16):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        for _ in range(20):
            common = some(rng.randint(100, 300))
            raw = [some(rng.randint(0, 200)) + common + some(rng.randint(0, 200)) for _ in range(3)] + [b"", some(99), b"x" * 250]
            a = suffix_dedup.Anchors(raw)
            at = {}
            for h, doc, low, high in zip(a.hash.tolist(), a.doc.tolist(), a.low.tolist(), a.high.tolist()):
                for start in range(low, high + 1):
                    assert at.setdefault((doc, start), h) == h
            assert set(at) == {(d, i) for d, r in enumerate(raw) for i in range(len(r) - suffix_dedup.LENGTH + 1)}
            by_string = {}
            for (d, i), h in at.items():
                assert by_string.setdefault(raw[d][i : i + suffix_dedup.LENGTH], h) == h


def test_repeated_paragraphs_are_found_and_clean_documents_left_alone(spark):
    passage, line = prose(50, 51), prose(51, 40)
    texts = {
        1: prose(60, 300, 6), 2: prose(61, 40) + " " + passage + " " + prose(62, 30), 3: prose(63, 55) + " " + passage + "\n" + prose(64, 10),
        4: prose(65, 60, 2) + "\n" + line, 5: prose(66, 50) + "\n" + edited(line, 9, 1) + "\n" + prose(67, 30), 6: prose(68, 200, 4),
        7: prose(60, 300, 6), 8: passage + "\n" + prose(69, 12), 9: line + "\n" + prose(70, 25) + "\n" + line, 10: "\n".join(prose(700 + i, 2) for i in range(30)),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    got = paragraphs.duplicate_paragraphs(docs).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4, 5, 7, 8, 9}
    assert {r.doc_id for r in got if r.removed} == {3, 5, 7, 8, 9}
    assert {(r.doc_id, r.cluster_doc_id) for r in got if r.removed} >= {(3, 2), (8, 2), (5, 4), (9, 4), (7, 1)}
    for r in got:
        words = texts[r.doc_id].split()
        assert r.start + r.words <= len(words) and r.removed == ((r.doc_id, r.start) != (r.cluster_doc_id, r.cluster_start))
    lines = {(r.doc_id, r.start) for r in got if r.kind == "line" and r.removed}
    assert {(9, 0), (9, 65), (5, 50)} <= lines


def test_every_passage_of_fifty_one_words_is_found(spark):
    rng = random.Random(5)
    data = []
    for i in range(60):
        passage = prose(1000 + i, 51)
        for half in (0, 1):
            data.append((2 * i + half, prose(5000 + 2 * i + half, rng.randint(1, 60)) + " " + passage + " " + prose(9000 + 2 * i + half, rng.randint(1, 60))))
    got = paragraphs.duplicate_paragraphs(spark.createDataFrame(data, "doc_id long, text string")).collect()
    pairs = {(r.doc_id, r.cluster_doc_id) for r in got if r.removed}
    assert pairs == {(2 * i + 1, 2 * i) for i in range(60)}


def test_paragraphs_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    got = QUERIES["op4_paragraph_dedup"](spark, SF_DIR).collect()
    lines = {}
    for r in sorted(docs.collect()):
        at = 0
        for x in r.text.split("\n"):
            n = len(x.encode().split())
            if n >= paragraphs.MIN_WORDS:
                lines[r.doc_id, at] = shingle_set(x)
            at += n
    keys = list(lines)
    linked = set()
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if 100 * len(lines[a] & lines[b]) >= paragraphs.PERCENT * len(lines[a] | lines[b]):
                linked |= {a, b}
    found = {(r.doc_id, r.start) for r in got if r.kind == "line"}
    assert found <= linked and len(found) >= 0.9 * len(linked)


def test_near_copies_in_a_family_of_one_template_are_found(spark):
    rng = random.Random(21)
    template = [f"t{i}" for i in range(40)]
    data = []
    for i in range(150):
        own = template[:30] + [f"o{i}x{k}" for k in range(10)]
        copy = [*own[:34], f"e{i}", *own[35:]]
        data += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(copy))]
    rng.shuffle(data)
    sets = {d: shingle_set(t) for d, t in data}
    similar = lambda a, b: 100 * len(sets[a] & sets[b]) >= paragraphs.PERCENT * len(sets[a] | sets[b])
    want = {(a, b) for a in sets for b in sets if a < b and similar(a, b)}
    assert want == {(2 * i, 2 * i + 1) for i in range(150)}
    got = paragraphs.duplicate_paragraphs(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()
    found = {(r.cluster_doc_id, r.doc_id) for r in got if r.kind == "line" and r.removed}
    # One pair in some 700 collides in no band.
    assert found <= want and len(found) >= 0.98 * len(want)


def test_a_family_of_copies_without_its_template_costs_few_candidates(spark, monkeypatch):
    rng = random.Random(4)
    template = prose(77, 100).split(" ")
    data = []
    for i in range(200):
        own = list(template)
        for k in rng.sample(range(100), 2):
            own[k] = f"e{i}x{k}"
        data.append((i, " ".join(own)))
    candidates, linked = [], ngram_join.linked

    def counted(pairs, *rest):
        candidates.append(pairs.count())
        return linked(pairs, *rest)

    monkeypatch.setattr(paragraphs, "linked", counted)
    got = paragraphs.duplicate_paragraphs(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()
    found = {r.doc_id: r.cluster_doc_id for r in got if r.kind == "line"}
    want = {doc: least for doc, _, least in brute_groups(data)}
    members = Counter(want.values())
    assert found == {doc: least for doc, least in want.items() if members[least] > 1}
    assert sum(candidates) < 12 * len(data)


def test_parities_bound_the_difference_of_sets():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (1, 40, 90, 400, 2000) for _ in range(4)] + [np.zeros(0, dtype=np.uint64)]
    bits = ngram_join.parities(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), len(sets))
    for a, x in zip(sets, bits, strict=True):
        for b, y in zip(sets, bits, strict=True):
            differ = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
            assert differ <= len(set(a.tolist()) ^ set(b.tolist())) and (differ > 0 or len(a) != 1 or len(b) > 1 or a.tolist() == b.tolist())


def wrapped(text: str, width: int) -> str:
    w = text.split(" ")
    return "\n".join(" ".join(w[i : i + width]) for i in range(0, len(w), width))


@pytest.mark.parametrize(("one", "other", "changed"), [(12, 12, 1), (12, 11, 0), (12, 11, 1), (9, 99, 1), (12, 45, 0)])
def test_wrapped_paragraphs_are_found(spark, one, other, changed):
    data = []
    for i in range(60):
        text = prose(3000 + i, 45)
        between = "\n\n" if i % 2 else "\n"  # blank lines or long lines stand around the paragraph
        around = [prose(k + i, 30 if between == "\n" else 12) for k in (4000, 5000, 6000, 7000)]
        data.append((2 * i, between.join([around[0], wrapped(text, one), around[1]])))
        data.append((2 * i + 1, between.join([around[2], wrapped(edited(text, 22, 1) if changed else text, other), around[3]])))
    got = paragraphs.duplicate_paragraphs(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()
    units = [r for r in got if r.kind != "passage"]
    assert {(r.doc_id, r.cluster_doc_id) for r in units if r.removed} == {(2 * i + 1, 2 * i) for i in range(60)}
    assert {(r.start, r.words) for r in units} == {(30, 45), (12, 45)}
    assert {r.kind for r in units if r.doc_id % 2 == 0} == {"block"} and {r.kind for r in units if r.doc_id % 2} == {"block" if other < 45 else "line"}


def test_joined_lines_do_not_overlap():
    rng = random.Random(8)
    for _ in range(50):
        docs = [[rng.choice([0, 3, 12, 19, 20, 40]) for _ in range(rng.randint(0, 12))] for _ in range(5)]
        want, at = [], 0
        for d in docs:
            run = None
            for i, n in enumerate([*d, 0]):
                if 0 < n < paragraphs.MIN_WORDS:
                    run = at + i if run is None else run
                    continue
                if run is not None:
                    want.append((run, at + i))
                run = None
                if n:
                    want.append((at + i, at + i + 1))
            at += len(d)
        words, doc = np.array([n for d in docs for n in d], dtype=np.int64), np.repeat(np.arange(5), [len(d) for d in docs])
        assert list(zip(*(x.tolist() for x in paragraphs.joined_lines(words, doc)), strict=True)) == want


def test_blocks_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.select((F.col("doc_id") + 1_000_000).alias("doc_id"), F.regexp_replace("text", r"((?:\S+ ){11}\S+) ", "$1\n").alias("text")))
    got = paragraphs.duplicate_paragraphs(docs).collect()
    units = {}
    for r in sorted(docs.collect()):
        own, at = [], 0
        for x in r.text.split("\n"):
            w = x.encode().split()
            if 0 < len(w) < paragraphs.MIN_WORDS and own and own[-1][2]:
                own[-1][1].append(x)
            else:
                own.append((at, [x], 0 < len(w) < paragraphs.MIN_WORDS))
            at += len(w)
        units |= {(r.doc_id, s): shingle_set(" ".join(x)) for s, x, _ in own if sum(len(y.encode().split()) for y in x) >= paragraphs.MIN_WORDS}
    keys, holders = list(units), {}
    for k in keys:
        for g in units[k]:
            holders.setdefault(g, []).append(k)
    linked = set()
    for a in keys:
        for b, both in Counter(h for g in units[a] for h in holders[g] if h != a).items():
            if 100 * both >= paragraphs.PERCENT * (len(units[a]) + len(units[b]) - both):
                linked |= {a, b}
    found = {(r.doc_id, r.start) for r in got if r.kind != "passage"}
    assert found <= linked and len(found) >= 0.98 * len(linked) > 0
    assert sum(r.kind == "block" for r in got) > 50


def test_paragraphs_of_odd_tables(spark):
    got = paragraphs.duplicate_paragraphs(odd_docs(spark)).collect()
    assert len(got) == len(set(got))
    assert {1, 2, 17, 6, 7, None} <= {r.doc_id for r in got} and not {8, 9, 10, 11, 12, 18, 19} & {r.doc_id for r in got}
    assert paragraphs.duplicate_paragraphs(empty_docs(spark)).count() == 0


# suffixes


def brute_spans(data, length):
    """What is left of each document, without every byte of a string that starts earlier too."""
    keys = sorted({r for r in data}, key=lambda k: (k[0] is not None, k[0] or 0))
    first, out = {}, {}
    for doc, text in keys:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - length + 1):
            if first.setdefault(raw[i : i + length], (doc, text, i)) != (doc, text, i):
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(raw) else 0
        out[doc, text] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return Counter((doc, *out[doc, text]) for doc, text in data)


@pytest.mark.parametrize("hot", [4000, 1])
def test_suffix_dedup_of_odd_tables(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
    rng = random.Random(3)
    passage = prose(80, 40)
    data = [(r[0], r[1]) for r in rows() if not (r[0] is None and r[1])]
    data += [(100 + i, prose(400 + i, rng.randint(0, 20)) + " " + passage + prose(500 + i, rng.randint(0, 20))) for i in range(30)]
    data += [(200 + i, edited(data[0][1], i, rng.randint(1, 8))) for i in range(20)]
    data += [(300, "ab" * 400), (301, "ab" * 100 + "c"), (302, "\U0001f600" * 60), (303, prose(90, 5) + "\U0001f600" * 50), (304, "x" * 99), (305, "x" * 101)]
    got = suffix_dedup.without_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(3), ranges=5)
    rows_got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect())
    assert rows_got == brute_spans(data, suffix_dedup.LENGTH)


def test_suffix_dedup_of_empty_and_clashing_tables(spark):
    assert suffix_dedup.without_repeats(empty_docs(spark)).count() == 0
    assert suffix_dedup.without_repeats(odd_docs(spark)).count() == len(rows())
    assert suffix_dedup.without_repeats(spark.createDataFrame([(None, None, "", "", 0)], SCHEMA)).first().n_bytes == 0


def test_transform_and_prefixes_are_those_of_sorted_suffixes(monkeypatch, tmp_path):
    rng = random.Random(6)
    monkeypatch.setattr(suffix_dedup, "LENGTH", 8)
    for trial in range(60):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(8, 20))) for _ in range(rng.randint(1, 10))]
        c = suffix_dedup.Collection(strings, str(tmp_path))
        suffixes = sorted((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
        # An end is smaller than any symbol; ends are ordered by string, at whatever depth they come.
        suffixes.sort(key=lambda x: [*(b + 100 for b in x[0]), x[1]])
        bwt, lcp = c._read()
        assert bwt.tolist() == [strings[k][i - 1] if i else suffix_dedup.BEGIN for _, k, i in suffixes], trial
        common = [0]
        for (a, *_), (b, *_) in zip(suffixes, suffixes[1:]):
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            common.append(min(n, 8))
        assert lcp.tolist() == common, trial


def test_collections_of_one_anchor_stay_together():
    frame = pd.DataFrame({"anchor": [2, 1, 2], "sid": [1, 1, 2], "known": [True, True, True], "number": [5, 1, 4], "text_hash": [0, 0, 0], "start": [3, 0, 7], "segment": [b"a" * 100 + b"bc", b"q" * 100, b"a" * 100 + b"bd"]})
    got = {r.number: (list(r.begins), list(r.ends)) for r in suffix_dedup.later_starts(frame).itertuples()}
    assert got == {5: ([3], [104])}
