"""Count word pieces by greedy longest match in one linear pass.

The vocabulary is a trie. Every node has a failure link, which says where matching goes on when a letter does not
fit, and the number of pieces that are complete by then; a transition table over bytes has both worked out in
advance. A word is counted by following the table once over its bytes; no piece is ever cut out.

Defined results: null and empty texts have no words and no pieces; a word that cannot be cut into pieces counts as
one piece; very long words are followed byte by byte like short ones.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, bounded

#: Where the box keeps its public vocabularies; a parameter everywhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Bytes of text worked on at a time, and the length from which a word is followed alone.
BATCH_BYTES = 4_000_000
LONG_WORD = 200


def byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def word_pieces(path: str = VOCABULARY) -> tuple[list[bytes], list[bytes]]:
    """Pieces that begin a word and pieces that go on in it, from a byte-level vocabulary.

    Tokens with a leading blank begin a word, all others go on in it. Every single byte may begin a word too, so
    that each word can be cut.
    """
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    letters = byte_letters()
    raw = [bytes(letters[c] for c in t) for t in vocab if all(c in letters for c in t)]
    begin = {t[1:] for t in raw if t[:1] == b" " and len(t) > 1} | {bytes([b]) for b in range(256)}
    return sorted(begin), sorted(t for t in raw if t[:1] != b" ")


class Automaton:
    """The transition table: ``go[node, byte]`` next node, ``done[node, byte]`` pieces completed on the way.

    Node 0 begins a word, node 1 stands after a complete piece, node 2 is the end of words that cannot be cut.
    ``tail[node]`` is the number of pieces completed when the word ends there, -1 where it cannot be cut.
    """

    def __init__(self, begin: Iterable[bytes], inside: Iterable[bytes]):
        child: list[dict[int, int]] = [{}, {}, {}]
        piece = [False, True, False]
        order: list[tuple[int, int, int]] = []
        for root, words in ((0, begin), (1, inside)):
            for w in words:
                at = root
                for b in w:
                    if b not in child[at]:
                        child[at][b] = len(child)
                        order.append((at, b, len(child)))
                        child.append({})
                        piece.append(False)
                    at = child[at][b]
                piece[at] = True
        n, dead = len(child), 2
        depth = np.zeros(n, dtype=np.int32)
        for parent, _, node in order:
            depth[node] = depth[parent] + 1
        go = np.full((n, 256), dead, dtype=np.int32)
        done = np.zeros((n, 256), dtype=np.uint16)
        fail = np.full(n, dead, dtype=np.int32)
        pops = np.zeros(n, dtype=np.int32)
        for b, node in child[1].items():
            go[1, b] = node
        for b, node in child[0].items():
            go[0, b] = node
        # Shallow nodes first: the link of a node leads to a shallower one, whose row is finished by then.
        for _, parent, b, node in sorted((depth[node], parent, b, node) for parent, b, node in order):
            if piece[node]:
                fail[node], pops[node] = 1, 1
            elif parent > 2 and fail[parent] != dead and go[fail[parent], b] != dead:
                fail[node] = go[fail[parent], b]
                pops[node] = pops[parent] + done[fail[parent], b]
            if fail[node] != dead:
                go[node] = go[fail[node]]
                done[node] = done[fail[node]] + pops[node]
            for c, kid in child[node].items():
                go[node, c], done[node, c] = kid, 0
        tail = np.full(n, -1, dtype=np.int32)
        tail[1] = 0
        for node in np.argsort(depth, kind="stable"):
            if node > 2 and fail[node] != dead and tail[fail[node]] >= 0:
                tail[node] = tail[fail[node]] + pops[node]
        self.go, self.done, self.tail = go, done, tail

    def count_word(self, word: bytes) -> int:
        at, n, go, done = 0, 0, self.go, self.done
        for b in word:
            n += int(done[at, b])
            at = int(go[at, b])
            if at == 2:
                return 1
        return n + int(self.tail[at]) if self.tail[at] >= 0 else 1

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of the words ``data[starts:ends]``; all words advance by one byte at a time."""
        flat_go, flat_done = self.go.reshape(-1), self.done.reshape(-1)
        length = ends - starts
        long = length > LONG_WORD
        total = np.zeros(len(starts), dtype=np.int64)
        order = np.argsort(-np.where(long, 0, length), kind="stable")
        at = np.zeros(len(order), dtype=np.int64)
        got = np.zeros(len(order), dtype=np.int64)
        first, by_length = starts[order], np.where(long, 0, length)[order]
        reach = len(order) - np.searchsorted(by_length[::-1], np.arange(1, LONG_WORD + 2), side="left")
        for step in range(LONG_WORD):
            m = reach[step]
            if not m:
                break
            cell = at[:m] * 256 + data[first[:m] + step]
            got[:m] += flat_done[cell]
            at[:m] = flat_go[cell]
        tail = self.tail[at]
        total[order] = np.where(tail >= 0, got + tail, 1)
        for i in np.flatnonzero(long):
            total[i] = self.count_word(data[starts[i] : ends[i]].tobytes())
        return total


@lru_cache(maxsize=2)
def _automaton(pieces: tuple[tuple[bytes, ...], tuple[bytes, ...]]) -> Automaton:
    return Automaton(*pieces)


IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[list(BLANKS)] = True


def count_texts(auto: Automaton, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Words and pieces of every text."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    words, found = np.zeros(len(raw), dtype=np.int64), np.zeros(len(raw), dtype=np.int64)
    for a, b in bounded(map(len, raw), BATCH_BYTES):
        data = np.frombuffer(b"\n" + b"\n".join(raw[a:b]) + b"\n", dtype=np.uint8)
        blank = IS_BLANK[data]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            continue
        first = np.cumsum([1, *(len(x) + 1 for x in raw[a:b])])[:-1]
        of = np.searchsorted(first, starts, side="right") - 1
        words[a:b] = np.bincount(of, minlength=b - a)
        found[a:b] = np.bincount(of, weights=auto.count(data, starts, ends), minlength=b - a).astype(np.int64)
    return words, found


def piece_counts(text: Column, docs: DataFrame, path: str = VOCABULARY) -> Column:
    """Struct of ``n_words`` and ``n_pieces`` of a text.

    The vocabulary is read by the driver and sent out with the function (as many bytes as the vocabulary file has
    at most); every worker builds the table once.
    """
    begin, inside = word_pieces(path)
    sent = docs.sparkSession.sparkContext.broadcast((tuple(begin), tuple(inside)))

    def count(texts: pd.Series) -> pd.DataFrame:
        words, found = count_texts(_automaton(sent.value), texts.tolist())
        return pd.DataFrame({"n_words": words, "n_pieces": found})

    return F.pandas_udf(count, "n_words long, n_pieces long")(text)


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_pieces``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), piece_counts(F.col(text), docs, path).alias("c"))
    return rows.select("doc_id", "c.n_words", "c.n_pieces")
