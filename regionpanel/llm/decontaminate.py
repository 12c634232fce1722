"""Find benchmark items in training documents: BM25 over the items, block-max WAND, then question and answer overlap.

The items are the indexed collection; every passage of every document is a query with all its terms. Impacts are BM25
scores divided by the score an item gives itself, so an item is retrieved from ``THRESHOLD`` on, whatever its length.
Postings are cut into blocks of items with their largest impacts. The sum of these over a passage bounds the score
of every item of a block; that test runs over all passages of a batch at once, and only what passes it is searched.
A retrieved item counts if the passage has ``OVERLAP`` percent of the shingles of the whole item, or of its question and
of its answer. One changed word takes up to ``SHINGLE`` shingles away, so answers under ``SHORT_WORDS`` words, of which
that would be more than is allowed, are also there with ``OVERLAP`` percent of their distinct words.

Passages are windows of twice the longest item, one item length apart, so each place where an item can stand lies
whole in one of them. The question of an item is the text before its last sentence, the answer the last sentence;
where there is one sentence only, the answer is the last quarter of its words.

Defined results: null and empty texts have no passages; items without words are never found; equal items are found
each under its own id; an item found in several passages of a document is reported once, with its best values; a very long
text has as many passages as it needs, all of which are looked at; without documents or items nothing is found.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, row_hash

K1, B = 1.2, 0.75
#: Share of an item's own score from which it is retrieved.
THRESHOLD = 0.7
OVERLAP = 75
SHINGLE = 5
#: From this many words on, one changed word leaves OVERLAP percent of the shingles.
SHORT_WORDS = -(-100 * SHINGLE // (100 - OVERLAP)) + SHINGLE - 1
#: Items of one index, which bounds what is sent to the workers, and items of one block.
INDEX_ITEMS = 20_000
BLOCK_ITEMS = 4
#: Terms in more items than this share are bounded by one number for all blocks.
COMMON = 0.1
BATCH_CHARS = 4_000_000

_TERM = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def grams(words: Sequence[str]) -> set[tuple[str, ...]]:
    """Distinct shingles; fewer words than a shingle has are one."""
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def question_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [p for p in (terms(x) for x in _SENTENCE.split(text)) if p]
    if len(parts) > 1:
        return list(chain.from_iterable(parts[:-1])), parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - -(-len(words) // 4) if len(words) > 1 else len(words)
    return words[:cut], words[cut:]


class Index:
    """Inverted index of items with normalised BM25 impacts in blocks."""

    def __init__(self, ids: Sequence[int | None], texts: Sequence[str | None]):
        items = [(i, t, terms(t)) for i, t in zip(ids, texts, strict=True) if t]
        items = [x for x in items if x[2]]
        items.sort(key=lambda x: (-len(x[2]), x[0] is None, x[0] or 0, x[1]))
        self.ids = [x[0] for x in items]
        parts = [question_answer(x[1]) for x in items]
        self.parts = [(grams(q), grams(r), grams(x[2])) for (q, r), x in zip(parts, items, strict=True)]
        self.short = [set(r) if len(r) < SHORT_WORDS else set() for _, r in parts]
        self.longest = max((len(x[2]) for x in items), default=1)
        n = len(items)
        mean = sum(len(x[2]) for x in items) / max(n, 1)
        counts = [Counter(x[2]) for x in items]
        df = Counter(t for c in counts for t in c)
        self.vocabulary = {t: k for k, t in enumerate(sorted(df))}
        idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
        postings: list[list[tuple[int, float]]] = [[] for _ in df]
        for i, c in enumerate(counts):
            length = K1 * (1 - B + B * sum(c.values()) / mean)
            score = {t: idf[t] * f * (K1 + 1) / (f + length) for t, f in c.items()}
            own = sum(score.values())
            for t, s in score.items():
                postings[self.vocabulary[t]].append((i, s / own))
        self.start = np.cumsum([0, *map(len, postings)])
        self.item = np.array([i for p in postings for i, _ in p], dtype=np.int64)
        self.score = np.array([s for p in postings for _, s in p])
        self.blocks = -(-n // BLOCK_ITEMS)
        # Largest impact of a term in each block that has it, all terms end to end.
        blocks, impacts, self.first = [], [], np.zeros(len(df) + 1, dtype=np.int64)
        self.common = np.zeros(len(df))
        for k in range(len(df)):
            at, impact = self.item[self.start[k] : self.start[k + 1]], self.score[self.start[k] : self.start[k + 1]]
            own, place = np.unique(at // BLOCK_ITEMS, return_inverse=True)
            most = np.zeros(len(own))
            np.maximum.at(most, place, impact)
            blocks.append(own)
            impacts.append(most)
            self.first[k + 1] = self.first[k] + len(own)
            if len(at) > COMMON * n:
                self.common[k] = impact.max()
        self.block = np.concatenate(blocks) if blocks else np.zeros(0, dtype=np.int64)
        self.impact = np.concatenate(impacts) if impacts else np.zeros(0)

    def bounds(self, half: np.ndarray, term: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages and blocks that the threshold may be reached in, from the terms of all half passages.

        A half is the first one of its passage and the second one of the passage before. Rare terms add their largest
        impact to the blocks that have them, common terms to all blocks alike.
        """
        second = (half > 0) & ~last[half - 1]
        half, term = np.r_[half, half[second] - 1], np.r_[term, term[second]]
        once = np.sort(half * len(self.common) + term)
        once = once[np.r_[True, once[1:] != once[:-1]]] if len(once) else once
        half, term = once // len(self.common), once % len(self.common)
        alike = np.bincount(half, weights=self.common[term], minlength=len(last))
        rare = self.common[term] == 0
        half, term = half[rare], term[rare]
        size = self.first[term + 1] - self.first[term]
        entry = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.first[term], size)
        cell = np.repeat(half, size) * self.blocks + self.block[entry]
        sums = np.bincount(cell, weights=self.impact[entry], minlength=len(last) * self.blocks).reshape(len(last), -1)
        return np.nonzero(sums + alike[:, None] >= THRESHOLD - 1e-6)

    def search(self, query: np.ndarray, blocks: Sequence[int]) -> list[tuple[int, float]]:
        """Items of the blocks whose score for the distinct terms ``query`` reaches the threshold.

        Only postings of these blocks are scored; all other blocks are skipped by their bounds.
        """
        a, size = self.start[query], self.start[query + 1] - self.start[query]
        entry = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)
        item, impact = self.item[entry], self.score[entry]
        if len(blocks) < self.blocks:
            here = np.zeros(self.blocks, dtype=bool)
            here[list(blocks)] = True
            inside = here[item // BLOCK_ITEMS]
            item, impact = item[inside], impact[inside]
        scores = np.bincount(item, weights=impact, minlength=len(self.ids))
        return [(int(i), float(scores[i])) for i in np.flatnonzero(scores >= THRESHOLD - 1e-9)]

    def overlaps(self, words: Sequence[str], item: int) -> tuple[int, int, int]:
        """Percent of the question's, the answer's and the whole item's shingles that a passage has; an empty part is there."""
        out, whole = [], grams(words)
        for part in self.parts[item]:
            here = whole if all(len(g) == SHINGLE for g in part) else {tuple(words[i : i + len(g)]) for g in part for i in range(len(words) - len(g) + 1)}
            out.append(100 * len(part & here) // len(part) if part else 100)
        return out[0], out[1], out[2]

    def short_answer(self, words: Sequence[str], item: int) -> int:
        """Percent of a short answer's distinct words that a passage has; 0 for longer answers."""
        short = self.short[item]
        return 100 * len(short.intersection(words)) // len(short) if short else 0

    def scan(self, texts: Sequence[str | None], edited: bool = False) -> list[tuple[int, int, float, int, int]]:
        """(text, item, score, question, answer) of all verified finds, best passage first found wins ties.

        Without ``edited`` only shingles of question and answer count; with it, as the operators ask, whole items and the
        words of short answers count too.
        """
        found: dict[tuple[int, int], tuple[float, int, int]] = {}
        if not self.ids:
            return []
        step = self.longest
        get = self.vocabulary.get
        for a, z in bounded((len(t) if t else 0 for t in texts), BATCH_CHARS):
            docs = [terms(t) if t else [] for t in texts[a:z]]
            count = np.array([len(d) for d in docs])
            halves = np.maximum(-(-count // step), 1)
            first = np.r_[0, np.cumsum(halves)]
            known = np.fromiter((get(w, -1) for d in docs for w in d), dtype=np.int64, count=int(count.sum()))
            place = np.arange(len(known)) - np.repeat(np.r_[0, np.cumsum(count)[:-1]], count)
            half = np.repeat(first[:-1], count) + place // step
            hit = known >= 0
            half, known = half[hit], known[hit]
            last = np.zeros(first[-1], dtype=bool)
            last[first[1:] - 1] = True
            worth: dict[int, list[int]] = {}
            for h, b in zip(*(x.tolist() for x in self.bounds(half, known, last)), strict=True):
                worth.setdefault(h, []).append(b)
            for h, blocks in worth.items():
                d = int(np.searchsorted(first, h, side="right") - 1)
                start = (h - int(first[d])) * step
                words = docs[d][start : start + 2 * step]
                query = np.array(sorted({k for k in map(get, words) if k is not None}), dtype=np.int64)
                for item, score in self.search(query, blocks):
                    q, r, both = self.overlaps(words, item)
                    if edited:
                        r = max(r, self.short_answer(words, item))
                    if (q >= OVERLAP and r >= OVERLAP) or (edited and both >= OVERLAP):
                        old = found.get((a + d, item))
                        found[(a + d, item)] = max(old, (score, q, r)) if old else (score, q, r)
        return [(d, i, *v) for (d, i), v in found.items()]


def indexes(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Index]:
    """One index for every ``INDEX_ITEMS`` items or so; only one is on the driver at a time."""
    groups = max(1, -(-items.count() // INDEX_ITEMS))
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    for g in range(groups):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).toPandas() if groups > 1 else rows.toPandas()
        ids = [None if pd.isna(i) else int(i) for i in part["item_id"]]
        yield Index(ids, [t if isinstance(t, str) else None for t in part["text"]])


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``item_id``, ``score``, ``question_percent``, ``answer_percent`` of every find."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    out = None
    for index in indexes(items, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def find(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            index = sent.value
            for part in batches:
                hits = index.scan([t if isinstance(t, str) else None for t in part["text"]], edited=True)
                at = [h[0] for h in hits]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].iloc[at].astype("Int64").to_numpy(), "text_hash": part["text_hash"].iloc[at].to_numpy(),
                        "item_id": pd.array([index.ids[h[1]] for h in hits], dtype="Int64"), "score": [h[2] for h in hits],
                        "question_percent": [h[3] for h in hits], "answer_percent": [h[4] for h in hits],
                    }
                )

        made = rows.mapInPandas(find, "doc_id long, text_hash long, item_id long, score double, question_percent long, answer_percent long")
        out = made if out is None else out.unionByName(made)
    return out


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    for index in indexes(items, item_id, item_text):
        docs = docs.filter(~_holds_item(docs.sparkSession.sparkContext.broadcast(index))(F.col(text)))
    return docs


def _holds_item(sent: Broadcast) -> Callable[[Column], Column]:
    def found(texts: pd.Series) -> pd.Series:
        hits = sent.value.scan([t if isinstance(t, str) else None for t in texts], edited=True)
        out = np.zeros(len(texts), dtype=bool)
        out[[h[0] for h in hits]] = True
        return pd.Series(out)

    return F.pandas_udf(found, "boolean")
