import re

import numpy as np
import pandas as pd
import pytest

from regionpanel.llm.chunked import chunks
from regionpanel.llm.common import WORD, bounded, words_of
from regionpanel.llm.components import components
from regionpanel.llm.shingles import BITS, pack, text_shingles, unpack


def test_words_are_those_of_the_pattern():
    text = "a b\tc\nd\x0be\x0cf\rg h  i\x1cj  "
    assert [w.decode() for w in words_of(text)] == re.findall(WORD, text)
    assert words_of(None) == words_of("") == words_of(" \n") == []


def test_ranges_cover_all_items_once():
    sizes = [3, 9, 1, 1, 20, 0, 5]
    cut = list(bounded(sizes, 10))
    assert [i for a, b in cut for i in range(a, b)] == list(range(len(sizes)))
    assert all(sum(sizes[a:b]) <= 10 or b - a == 1 for a, b in cut)
    assert list(bounded([], 10)) == []


@pytest.mark.parametrize("numbers", [[], [0], [5, 5, 9, 2**47], [9, 1, 4], list(range(0, 90000, 7)), [2**60, 1]])
def test_packed_numbers_come_back(numbers):
    x = np.array(numbers, dtype=np.uint64)
    assert unpack(pack(x)).tolist() == x.tolist()


def test_shingles_are_windows_of_words():
    texts = ["a b c d e f", "A B C D E F", "a b", "", None, "b c d e f", "a b a b a b a"]
    h, of = text_shingles(texts)
    got = [h[of == i].tolist() for i in range(len(texts))]
    assert [len(g) for g in got] == [2, 2, 1, 0, 0, 1, 3]
    assert got[0] == got[1] and got[0][1] == got[5][0] and got[6][0] == got[6][2]
    assert max(max(g, default=0) for g in got) < 1 << BITS
    assert text_shingles(texts, lower=False)[0][0] != text_shingles(texts, lower=False)[0][2]


def test_chunks_of_neighbouring_large_ids_differ():
    def identity(*ids):
        batch = pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "text_hash": np.ones(len(ids), dtype=np.int64), "text": ["a b c"] * len(ids)})
        return [chunk for chunk, *_ in chunks(iter([batch]), 1000)]

    assert identity(2**53, 1) == identity(2**53, 1) != identity(2**53 + 1, 1)
    assert identity(0, 1) != identity(None, 1)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
