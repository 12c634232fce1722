"""Remove every byte of a long repeat, from the Burrows-Wheeler transform of a collection built column by column.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier: in a smaller document, or before it in
the same one. Strings are judged on the input and never cross documents.

Two equal strings of ``LENGTH`` bytes hold the same anchor: the first smallest hash among their ``GRAM``-byte grams. So
the work is spread by anchors. Chunks of documents send their distinct anchors, packed and counted, to hash ranges and
get back those that occur more than once; around each of these a segment is cut out that holds all strings with that
anchor. Equal segments are one, kept at their earliest place; all later ones are covered as a whole. Segments of an
anchor that has several different ones become a collection: its transform and the common prefixes of neighbouring
suffixes are built one column at a time, from the last symbol of every segment to its first, each round reading the two
files of the round before once and writing them anew. Strings that share ``LENGTH`` symbols are then neighbours, and
all but the earliest are repeats.

An anchor with more than ``HOT_SEGMENTS`` different segments would not fit one task. Its strings are spread by their
own digest instead, and the earliest of each is found by grouping.

Defined results: null and empty texts have no bytes; texts shorter than ``LENGTH`` stay; "earlier" is a smaller id (null
before all), then text hash, then start; rows alike in id and text are judged as one document and answered each.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunked import among, second_look
from .common import bounded, row_hash, settle
from .shingles import BITS, mixed

LENGTH = 100
#: Bytes of a gram, a multiple of 8.
GRAM = 48
#: Starts of a long text that are looked at together.
BLOCK = 1 << 16
ODD = mixed(np.arange(1, 10, dtype=np.uint64)) | np.uint64(1)
HIGH, LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
HOT_SEGMENTS = 4_000
#: Symbols of one collection that a task builds at a time.
COLLECTION_BYTES = 120_000
#: Bytes of text that are looked at together; equal segments in them travel once.
CHUNK_BYTES = 6_000_000
#: Marks the begin of a string in a transform; a byte that UTF-8 does not use.
BEGIN = 255


def block_anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes of the strings of ``LENGTH`` bytes that start in ``data``, and the first and last start of each.

    The gram's hash above its place makes one number, so the smallest of a window is the first smallest hash. Window
    minima come from running minima forward and backward in blocks of one window (van Herk).
    """
    n, width = len(data) - GRAM + 1, LENGTH - GRAM + 1
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    h = eight[:n] * ODD[0]
    for k in range(1, GRAM // 8):
        h += eight[8 * k : n + 8 * k] * ODD[k]
    h ^= h >> np.uint64(29)
    h *= ODD[-1]
    h ^= h >> np.uint64(32)
    key = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    key[:n] = h & HIGH | np.arange(n, dtype=np.uint64)
    rows = key.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(back[: n - width + 1], ahead[width - 1 : n])
    place = (least & LOW).astype(np.int64)
    change = np.flatnonzero(place[1:] != place[:-1])
    low = np.r_[0, change + 1]
    return h[place[low]] >> np.uint64(64 - BITS), low, np.r_[change, len(place) - 1]


class Anchors:
    """For every anchor of some texts its hash, its document, and the first and last start of a string it belongs to.

    Long texts are taken in blocks, whose strings overlap so that each has its whole length; an anchor at a border
    counts twice, which only means another look at it.
    """

    def __init__(self, raw: list[bytes]):
        found = []
        for doc, r in enumerate(raw):
            data = np.frombuffer(r, dtype=np.uint8)
            for at in range(0, len(r) - LENGTH + 1, BLOCK):
                h, low, high = block_anchors(data[at : at + BLOCK + LENGTH - 1])
                found.append((h, low + at, high + at, np.full(len(h), doc)))
        nothing = (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
        self.hash, self.low, self.high, self.doc = (np.concatenate(x) for x in zip(*(found or [nothing]), strict=True))


def anchor_hashes(raw: list[bytes]) -> np.ndarray:
    return Anchors(raw).hash


def cut_segments(ids: pd.Series, hashes: np.ndarray, raw: list[bytes], found: np.ndarray) -> pd.DataFrame:
    """Segments of a chunk's texts around the anchors in ``found``.

    Of equal segments only the earliest of the chunk goes on. The others are repeats already: their bytes come as
    spans, joined per document, in rows with the anchor -1 and a ``sid`` of their own.
    """
    known, number = ids.notna().to_numpy(), ids.fillna(0).astype("int64").to_numpy()
    # Rows alike in id and text are one document: a segment is no repeat of itself in the other row.
    once = ~pd.DataFrame({"known": known, "number": number, "hash": hashes}).duplicated().to_numpy()
    ids, known, number, hashes = ids[once], known[once], number[once], hashes[once]
    raw = [r for r, keep in zip(raw, once.tolist(), strict=True) if keep]
    a = Anchors(raw)
    use = np.flatnonzero(among(a.hash, found))
    doc, low, high, anchor = a.doc[use], a.low[use], a.high[use], a.hash[use].astype(np.int64)
    pieces = [raw[d][x : y + LENGTH] for d, x, y in zip(doc.tolist(), low.tolist(), high.tolist(), strict=True)]
    sid = np.fromiter((xxhash.xxh3_64_intdigest(p) >> 1 for p in pieces), dtype=np.int64, count=len(pieces))
    place = np.empty(len(ids), dtype=np.int64)  # documents in their order
    place[np.lexsort((hashes, number, known))] = np.arange(len(ids))
    by = np.lexsort((low, place[doc], sid, anchor))
    new = np.ones(len(by), dtype=bool)
    new[1:] = (anchor[by][1:] != anchor[by][:-1]) | (sid[by][1:] != sid[by][:-1])
    first, rest = np.sort(by[new]), np.sort(by[~new])
    spans = []
    if len(rest):
        cut = np.flatnonzero(np.diff(doc[rest])) + 1
        for part in np.split(rest, cut):
            begins, ends = union_of(low[part], high[part] + LENGTH)
            spans += [(doc[part[0]], b, e) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
    at, begins, ends = np.array(spans, dtype=np.int64).reshape(-1, 3).T
    docs = np.r_[doc[first], at]
    own = mixed(hashes[at].astype(np.uint64) ^ begins.astype(np.uint64)) >> np.uint64(1)
    return pd.DataFrame(
        {
            "anchor": np.r_[anchor[first], np.full(len(at), -1)], "sid": np.r_[sid[first], own.astype(np.int64)],
            "doc_id": pd.array(ids.iloc[docs], dtype="Int64"), "text_hash": hashes[docs],
            "start": np.r_[low[first], begins], "starts": np.r_[high[first] - low[first] + 1, ends - begins],
        }
    )


def segments(texts: DataFrame, ranges: int) -> DataFrame:
    """``anchor``, ``sid``, place and ``starts`` (strings in it) of segments around repeated anchors, equal ones once per
    chunk; and ``start`` and length (``starts``) of the spans that the others cover, with the anchor -1."""
    out = "anchor long, sid long, doc_id long, text_hash long, start long, starts long"
    return second_look(texts, anchor_hashes, cut_segments, out, ranges, CHUNK_BYTES)


def with_bytes(places: DataFrame, texts: DataFrame) -> DataFrame:
    """Segments at ``places`` with their bytes. A document's places go to its text, which is cut there."""
    wanted = places.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("anchor", "sid", "n", "start", "starts")).alias("wanted"))
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["text_hash"] == wanted["text_hash"])
    rows = texts.join(wanted, same).select(texts["doc_id"].isNotNull().alias("known"), F.coalesce(texts["doc_id"], F.lit(0)).alias("number"), texts["text_hash"], "text", "wanted")
    # Rows alike in id and text ask for the same segments.
    rows = rows.dropDuplicates(["known", "number", "text_hash"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for known, number, text_hash, text, wanted in batch.itertuples(index=False):
                raw = text.encode("utf-8", "surrogatepass")
                out += [(w["anchor"], w["sid"], w["n"], known, number, text_hash, w["start"], w["starts"], raw[w["start"] : w["start"] + w["starts"] - 1 + LENGTH]) for w in wanted]
            yield pd.DataFrame(out, columns=["anchor", "sid", "n", "known", "number", "text_hash", "start", "starts", "segment"])

    return rows.mapInPandas(cut, "anchor long, sid long, n long, known boolean, number long, text_hash long, start long, starts long, segment binary")


class Collection:
    """Burrows-Wheeler transform and common prefixes of many short strings, one column a round.

    Symbols are bytes; ``BEGIN``, which no UTF-8 text has, marks the begin of a string and stands behind all others. The
    strings' ends come first in the order, by number of the string. ``folder`` holds one file with the transform and one with the common prefixes (up to ``LENGTH``).
    """

    def __init__(self, strings: list[bytes], folder: str):
        self.files = [os.path.join(folder, x) for x in ("transform", "prefixes")]
        for name in self.files:
            open(name, "wb").close()
        self.m = m = len(strings)
        size = np.array([len(s) for s in strings], dtype=np.int64)
        data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        end = np.cumsum(size)
        self.size = size
        place = np.arange(m)
        active = np.arange(m)
        self._write(data[end - 1], np.zeros(m, dtype=np.uint8))
        for column in range(1, int(size.max()) + 1):
            bwt, lcp = self._read()
            # One stable sort gives, symbol by symbol, the order of the suffixes that begin with it.
            order = np.argsort(bwt, kind="stable")
            old = place[active]
            rank = np.empty(len(bwt), dtype=np.int32)
            rank[order] = np.arange(len(bwt), dtype=np.int32)
            r = rank[old].astype(np.int64)
            symbol = np.where(column < size[active], data[np.maximum(end[active] - column - 1, 0)], BEGIN).astype(np.uint8)
            new = m + r
            # Common prefix with the suffix before, and of the one after with this one: one more than between
            # the places the two come from.
            first = bwt[order[np.maximum(r - 1, 0)]] != bwt[old]
            first |= r == 0
            own = np.where(first, 0, 1 + self._least(lcp, order[np.maximum(r - 1, 0)] + 1, old))
            after = np.minimum(r + 1, len(bwt) - 1)
            follows = (r + 1 < len(bwt)) & (bwt[order[after]] == bwt[old])
            nxt = 1 + self._least(lcp, old + 1, np.where(follows, order[after], old + 1))
            fresh = np.zeros(len(bwt) + len(active), dtype=bool)
            fresh[new] = True
            out, common = np.empty(len(fresh), dtype=np.uint8), np.empty(len(fresh), dtype=np.uint8)
            out[~fresh], common[~fresh] = bwt, lcp
            out[new], common[new] = symbol, np.minimum(own, LENGTH)
            common[new[follows] + 1] = np.minimum(nxt[follows], LENGTH)
            self._write(out, common)
            place[active] = new
            # Places of strings that have ended move along as well, but nobody asks for them any more.
            active = active[column < size[active]]

    @staticmethod
    def _least(lcp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Smallest of ``lcp[a .. b]`` for each pair; taken from the right, so that no stretch between pairs is read."""
        if not len(a):
            return np.zeros(0, dtype=np.int64)
        by = np.argsort(-a, kind="stable")
        pairs = np.empty(2 * len(a), dtype=np.int64)
        pairs[::2] = a[by]
        pairs[1::2] = np.maximum(b, a)[by] + 1
        out = np.empty(len(a), dtype=np.int64)
        out[by] = np.minimum.reduceat(np.append(lcp, np.uint8(255)), np.minimum(pairs, len(lcp)))[::2]
        return out

    def _read(self) -> tuple[np.ndarray, np.ndarray]:
        return np.fromfile(self.files[0], dtype=np.uint8), np.fromfile(self.files[1], dtype=np.uint8)

    def _write(self, bwt: np.ndarray, lcp: np.ndarray) -> None:
        """Both only grow, so the files are written over from their begin."""
        for name, x in zip(self.files, (bwt, lcp), strict=True):
            with open(name, "r+b") as f:
                x.tofile(f)

    def groups(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Strings, start in them and group of all suffixes of at least ``LENGTH`` symbols, column by column."""
        bwt, lcp = self._read()
        group = np.cumsum(lcp < LENGTH)
        order = np.argsort(bwt, kind="stable")
        step = np.empty(len(bwt), dtype=np.int64)
        step[order] = np.arange(len(bwt)) + self.m
        place, active = np.arange(self.m), np.arange(self.m)
        for column in range(1, int(self.size.max()) + 1):
            active = active[self.size[active] >= column]
            place[active] = step[place[active]]
            if column >= LENGTH:
                yield active, self.size[active] - column, group[place[active]]


def repeats_of(strings: list[bytes], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """String and start of every ``LENGTH``-symbol substring that an earlier place has too."""
    with tempfile.TemporaryDirectory() as folder:
        found = list(Collection(strings, folder).groups())
    string, at, group = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.lexsort((start[string] + at, doc[string], group))
    string, at, group = string[order], at[order], group[order]
    later = np.zeros(len(group), dtype=bool)
    later[1:] = group[1:] == group[:-1]
    return string[later], at[later]


LATER = "known boolean, number long, text_hash long, begins array<long>, ends array<long>"


def later_starts(classes: pd.DataFrame) -> pd.DataFrame:
    """Spans of the segments' documents whose strings start earlier in another segment of the same anchor."""
    classes = classes.sort_values(["anchor", "sid"], kind="stable")
    out = []
    sizes = classes.groupby("anchor", sort=False)["segment"].agg(lambda s: sum(map(len, s)))
    first = np.r_[0, np.cumsum(classes.groupby("anchor", sort=False).size().to_numpy())]
    # Nulls come first in the order of documents.
    doc = classes.groupby(["known", "number", "text_hash"], sort=True).ngroup().to_numpy()
    start = classes["start"].to_numpy()
    owner = list(zip(classes["known"].tolist(), classes["number"].tolist(), classes["text_hash"].tolist(), strict=True))
    for a, b in bounded(sizes.tolist(), COLLECTION_BYTES):
        x, y = first[a], first[b]
        string, at = repeats_of(classes["segment"].iloc[x:y].tolist(), doc[x:y], start[x:y])
        order = np.lexsort((at, string))
        string, at = string[order], at[order]
        own, begin = np.unique(string, return_index=True)
        for s, part in zip(own, np.split(at, begin[1:]), strict=True) if len(own) else ():
            part = part + start[x + s]
            out.append((*owner[x + s], *union_of(part, part + LENGTH)))
    return pd.DataFrame(out, columns=["known", "number", "text_hash", "begins", "ends"])


def later_in_hot(classes: DataFrame) -> DataFrame:
    """`later_starts` of anchors with very many segments: each string by itself, the earliest of each by grouping."""
    rows = classes.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("starts") - 1)))
    rows = rows.withColumn("string", F.md5(F.substring("segment", F.col("at").cast("int") + 1, F.lit(LENGTH))))
    here = F.struct("known", "number", "text_hash", (F.col("start") + F.col("at")).alias("start"))
    rows = rows.select("string", here.alias("here"))
    earliest = rows.groupBy("string").agg(F.min("here").alias("least"))
    rows = rows.join(earliest, "string").filter(F.col("here") != F.col("least"))
    begin = F.col("here.start")
    return rows.select("here.known", "here.number", "here.text_hash", F.array(begin).alias("begins"), F.array(begin + LENGTH).alias("ends"))


def repeated_spans(texts: DataFrame, ranges: int | None = None) -> DataFrame:
    """``doc_id``, ``text_hash``, ``begin``, ``end`` of the repeats in ``texts`` (doc_id, text_hash, text); they may overlap."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = segments(texts, ranges or 2 * parts)
    # Equal segments meet, at most one of a chunk; the earliest is the one that strings are compared with.
    by = Window.partitionBy("anchor", "sid").orderBy("doc_id", "text_hash", "start")
    # Places of rows alike in id and text are the same place: none of them is a copy, and one of them goes on.
    found = settle(found.withColumns({"nth": F.rank().over(by), "row": F.row_number().over(by)}), "segments")
    spans = found.filter("anchor = -1").select("doc_id", "text_hash", F.col("start").alias("begin"), (F.col("start") + F.col("starts")).alias("end"))
    copies = found.filter("anchor >= 0 AND nth > 1")
    copies = copies.select("doc_id", "text_hash", F.col("start").alias("begin"), (F.col("start") + F.col("starts") - 1 + LENGTH).alias("end"))
    firsts = found.filter("anchor >= 0 AND row = 1").drop("nth", "row")
    counts = settle(firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "anchor-counts")
    usual = with_bytes(firsts.join(counts.filter(F.col("n") <= HOT_SEGMENTS), "anchor"), texts)
    usual = usual.select(F.pmod(F.xxhash64("anchor"), F.lit(4 * parts)).alias("bucket"), "anchor", "sid", "known", "number", "text_hash", "start", "segment")
    later = usual.groupBy("bucket").applyInPandas(later_starts, LATER)
    hot = counts.filter(F.col("n") > HOT_SEGMENTS)
    if not hot.isEmpty():
        later = later.unionByName(later_in_hot(with_bytes(firsts.join(hot, "anchor"), texts)))
    later = later.select(F.when(F.col("known"), F.col("number")).alias("doc_id"), "text_hash", F.explode(F.arrays_zip("begins", "ends")).alias("s"))
    later = later.select("doc_id", "text_hash", F.col("s.begins").alias("begin"), F.col("s.ends").alias("end"))
    return spans.unionByName(copies).unionByName(later)


def union_of(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans."""
    order = np.argsort(begins, kind="stable")
    b, e = begins[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, b[1:] > e[:-1]]
    at = np.flatnonzero(new)
    return b[at], e[np.r_[at[1:], len(e)] - 1]


KEPT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None, bytes_too: bool = True) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and the ``kept`` bytes."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    spans = repeated_spans(texts, ranges)
    spans = spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    same = texts["doc_id"].eqNullSafe(spans["doc_id"]) & (texts["text_hash"] == spans["text_hash"])
    rows = texts.join(spans, same, "left").select(texts["doc_id"], texts["text_hash"], "text", "spans.begin", "spans.end")

    def rest(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
        out = []
        for t, b, e in zip(texts, begins, ends, strict=True):
            raw = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
            kept, removed, runs = raw, 0, 0
            if b is not None and len(b):
                b, e = union_of(np.asarray(b, dtype=np.int64), np.asarray(e, dtype=np.int64))
                kept = b"".join(raw[x:y] for x, y in zip([0, *e.tolist()], [*b.tolist(), len(raw)], strict=True))
                removed, runs = int((e - b).sum()), len(b)
            out.append((len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), kept if bytes_too else None))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.select("doc_id", "text_hash", F.pandas_udf(rest, KEPT)("text", "begin", "end").alias("k")).select("doc_id", "text_hash", "k.*")
