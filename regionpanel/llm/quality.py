"""Quality rules on repetition, from the suffix array of a document's words.

Suffixes are sorted by prefix doubling; the common prefix of neighbours in that order is the length of the longest
substring that starts at a word and occurs again. The spans of these maximal repeats are joined, and a document is
rejected if they cover too much of it or if one repeat is too long. Many short documents share one array: their
words get numbers that no other document has.

Defined results: null, empty and blank-only texts have no words, fail the base rules and are not kept; repeated
rows are judged alike; every text is taken whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, bounded, words_of

SYMBOLS = b"#*$%&|<>"
#: Words that one suffix array holds; a longer document has one of its own.
ARRAY_WORDS = 400_000
#: Characters of text whose words are held at a time.
BATCH_CHARS = 1_000_000

MIN_WORDS = 10
WINDOW = 5
MOST_REPEATED_PERCENT = 20
#: The method's rule: repeats of at least so many words, the share of words they may cover, the longest one allowed.
REPEAT_WORDS = 20
MOST_COVERED_PERCENT = 15
LONGEST_REPEAT = 100

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_covered_words long, longest_repeat long, base_failed boolean, kept boolean"
)


def suffix_order(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of sequences put end to end, and the ranks by the first 1, 2, 4 ... symbols.

    ``symbols`` of different sequences differ; ``ends[i]`` is where the sequence of position ``i`` ends. Only
    suffixes that still equal another one are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    s = symbols[order]
    new = np.r_[True, s[1:] != s[:-1]]
    head = np.flatnonzero(new)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = head[np.cumsum(new) - 1]
    levels, width = [rank], 1
    open_at = np.flatnonzero(~(new & np.r_[new[1:], True]))
    while len(open_at):
        p = order[open_at]
        nxt = p + width
        inside = nxt < ends[p]
        second = np.where(inside, rank[np.where(inside, nxt, 0)] + 1, 0)
        first = rank[p]
        by = np.lexsort((second, first))
        p, first, second = p[by], first[by], second[by]
        order[open_at] = p
        new_group = np.r_[True, first[1:] != first[:-1]]
        new = new_group | np.r_[True, second[1:] != second[:-1]]
        head = open_at[np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))]
        rank = rank.copy()
        rank[p] = head
        levels.append(rank)
        width *= 2
        open_at = open_at[~(new & np.r_[new[1:], True])]
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in ``order`` (0 for the first)."""
    n = len(order)
    lcp = np.zeros(n, dtype=np.int64)
    if n < 2:
        return lcp
    same = levels[0][order[1:]] == levels[0][order[:-1]]
    at = np.flatnonzero(same) + 1
    a, b = order[at - 1].copy(), order[at].copy()
    got = np.zeros(len(at), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        width = 1 << k
        ok = (a + width <= ends[order[at - 1]]) & (b + width <= ends[order[at]])
        ok &= levels[k][np.where(ok, a, 0)] == levels[k][np.where(ok, b, 0)]
        got += ok * width
        a += ok * width
        b += ok * width
    lcp[at] = got
    return lcp


def repeat_lengths(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every position the length of the longest substring starting there that starts elsewhere as well."""
    order, levels = suffix_order(symbols, ends)
    lcp = common_prefixes(order, levels, ends)
    longest = np.empty(len(symbols), dtype=np.int64)
    longest[order] = np.maximum(lcp, np.r_[lcp[1:], 0])
    return longest


def covered(lengths: np.ndarray) -> np.ndarray:
    """Marks the positions inside the spans [i, i + lengths[i])."""
    n = len(lengths)
    at = np.flatnonzero(lengths)
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + lengths[at], -1)
    return np.cumsum(depth[:n]) > 0


def repetition(docs: list[list[bytes]]) -> np.ndarray:
    """Per document: words in repeated windows, words covered by long repeats, the longest repeat."""
    out = np.zeros((len(docs), 3), dtype=np.int64)
    sizes = [len(d) for d in docs]
    for a, b in bounded(sizes, ARRAY_WORDS):
        count = np.array(sizes[a:b])
        if not count.sum():
            continue
        ids: dict[bytes, int] = {}
        words = np.fromiter((ids.setdefault(w, len(ids)) for d in docs[a:b] for w in d), dtype=np.int64, count=count.sum())
        of = np.repeat(np.arange(b - a), count)
        longest = repeat_lengths(of * len(ids) + words, np.repeat(np.cumsum(count), count))
        windows = covered(np.where(longest >= WINDOW, WINDOW, 0))
        spans = covered(np.where(longest >= REPEAT_WORDS, longest, 0))
        out[a:b, 0] = np.bincount(of, weights=windows, minlength=b - a)
        out[a:b, 1] = np.bincount(of, weights=spans, minlength=b - a)
        np.maximum.at(out[:, 2], of + a, longest)
    return out


def measure(texts: list[str | None]) -> pd.DataFrame:
    """All figures of the rules, one row per text; words are held for some texts at a time."""
    parts = [_measure(texts[a:b]) for a, b in bounded((len(t) if t else 0 for t in texts), BATCH_CHARS)]
    return pd.concat(parts or [_measure([])], ignore_index=True)


def _measure(texts: list[str | None]) -> pd.DataFrame:
    docs = [words_of(t) for t in texts]
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    n = np.array([len(d) for d in docs], dtype=np.int64)
    chars = [len(t) - len(r) + len(r.translate(None, BLANKS)) if t else 0 for t, r in zip(texts, raw, strict=True)]
    symbols = [len(r) - len(r.translate(None, SYMBOLS)) for r in raw]
    repeats = repetition(docs)
    dup_lines = []
    for r in raw:
        lines = [x for x in r.split(b"\n") if x.strip(BLANKS)]
        dup_lines.append(len(lines) - len(set(lines)))
    base_failed = (n < MIN_WORDS) | (100 * repeats[:, 0] > MOST_REPEATED_PERCENT * n)
    method_failed = (100 * repeats[:, 1] > MOST_COVERED_PERCENT * n) | (repeats[:, 2] > LONGEST_REPEAT)
    return pd.DataFrame(
        {
            "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
            "n_repeat_words": repeats[:, 0], "n_covered_words": repeats[:, 1], "longest_repeat": repeats[:, 2],
            "base_failed": base_failed, "kept": ~(base_failed | method_failed),
        }
    )


def judge(text: Column) -> Column:
    """Struct of all figures and the verdict for a text column."""

    def figures(texts: pd.Series) -> pd.DataFrame:
        return measure([t if isinstance(t, str) else None for t in texts])

    return F.pandas_udf(figures, RESULT)(text)


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the figures, ``base_failed`` and ``kept``."""
    return docs.select(F.col(doc_id).alias("doc_id"), judge(F.col(text)).alias("q")).select("doc_id", "q.*")


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return docs.filter(judge(F.col(text)).getField("kept"))
