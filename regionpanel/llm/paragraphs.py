"""Remove repeated paragraphs: MinHash bands, exact Jaccard, components.

Paragraphs come in three kinds. A ``line`` of at least ``MIN_WORDS`` words is one by itself. Shorter lines are wrapped text:
those that stand together, without a blank or a long line between them, are joined, and from ``MIN_WORDS`` words on they are a
``block``. So a text counts the same however it is wrapped below ``MIN_WORDS`` words a line, or not wrapped at all. Lines and
blocks never overlap; both are compared by the MinHash of their word shingles, and those that collide in a band are checked
on their whole shingle sets. A ``passage`` stands inside a line or across lines and has no
borders of its own; it is cut out where the content says so: among every ``ANCHOR_WINDOW`` shingles in a row the
smallest hash marks a place, and the ``PASSAGE_WORDS`` words from there on are a paragraph. Any run of
``ANCHOR_WINDOW + PASSAGE_WORDS - 1`` words (50) that two documents share holds the same one in both. Its digest decides
alone, for equal passages have a similarity of 1.

Features that meet no other (digests and band keys) are sorted out first, so only paragraphs that may have a repeat are
kept. Equal paragraphs are one class, whose earliest place stands for it. Classes that share a bucket are first checked
against the leader of their fullest bucket, then, where that left them apart, against one in each band, which costs rows in
proportion to the bucket. What is left goes through the exact join of
``ngram_join``: members of a posting list first meet ``LEADERS`` of them, then every pair of groups still different that shares
enough of its rarest shingles, and whose sets' parities allow it, is checked, so no two of them that
collide and are similar enough stay apart, whoever leads. Connected classes are a cluster. The earliest paragraph of a
cluster stays and all others go.

Defined results: null and empty texts have no paragraphs; lines and blocks below ``MIN_WORDS`` words are left alone; "earlier" is a smaller id, then
text hash, then place; rows alike in id and text count once; a paragraph repeated in one document is removed there too; a very long text is a chunk
of its own; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunked import among, second_look
from .common import bounded, row_hash, settle
from .components import components
from .ngram_join import PARITY_WORDS, linked, main_pairs, mixed_lists, parities, prefixes, several_leader_pairs
from .shingles import BITS, SHINGLE_WORDS, Words, mixed, shingles, text_shingles

PERCENT = 75
MIN_WORDS = 20
PASSAGE_WORDS = 28
ANCHOR_WINDOW = 23
#: At a similarity of 0.75 a pair collides in one of the bands with a probability of 1 - (1 - 0.75^2)^8 = 0.9987.
BANDS, ROWS = 8, 2
#: Members of a posting list that all others of it meet, before members of different groups do.
LEADERS = 32
#: Characters of lines whose shingles are made at once.
TOKEN_CHARS = 1_000_000

UNIT = "doc_id long, text_hash long, start long, words long, kind string, digest long, bands array<long>, line string"


def window_minima(x: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Places of the first smallest value in every ``width`` values of the same sequence; short sequences are one window.

    ``ends[i]`` is where the sequence of ``i`` ends. Minima of windows of a power of two, two of which cover any width.
    """
    n = len(x)
    if not n:
        return np.zeros(0, dtype=np.int64)
    best = np.arange(n)
    span = 1
    while span < width:
        step = min(span, width - span)
        other = np.minimum(np.arange(n) + step, n - 1)
        # Reaching past the end of a sequence keeps the window at what is left of it.
        inside = np.arange(n) + step < ends
        a, b = best, best[other]
        best = np.where(inside & (x[b] < x[a]), b, a)
        span += step
    starts = np.r_[True, ends[1:] != ends[:-1]]
    whole = (np.arange(n) + width <= ends) | starts
    return np.unique(best[whole])


def joined_lines(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and line after the last of every long line and of every run of neighbouring short ones of a document."""
    short = (words > 0) & (words < MIN_WORDS)
    on = np.zeros(len(words), dtype=bool)
    on[1:] = short[1:] & short[:-1] & (doc[1:] == doc[:-1])
    first = np.flatnonzero((words > 0) & ~on)
    last = np.ones(len(words), dtype=bool)
    last[:-1] = ~on[1:]
    return first, np.flatnonzero((words > 0) & last) + 1


class Paragraphs:
    """Lines, blocks and passages of some texts: document, start in words, length in words and digest; band keys of the first two.

    ``line_from`` and ``line_to`` are the lines, of all texts end to end, that a line or block is made of.
    Words are taken in lower case (A to Z). All digests are made of the texts' shingle hashes: a line's or block's from
    the sum of its shingles, a passage's from shingles that cover it.
    """

    def __init__(self, raw: list[bytes]):
        w = Words([r.lower() for r in raw])
        # Texts stand one after the other with a line feed behind each, so every line ends with one.
        breaks = np.flatnonzero(w.data == ord("\n"))
        per_line = np.bincount(np.searchsorted(breaks, w.begin), minlength=len(breaks))
        line_doc = np.searchsorted(w.text_begin, np.r_[0, breaks[:-1] + 1], side="right") - 1
        words = w.counts
        h, of = shingles(w.hashes, words)
        size = np.bincount(of, minlength=len(raw)).astype(np.int64)
        shift = (np.cumsum(size) - size) - (np.cumsum(words) - words)  # from a document's words to its shingles
        begin = np.cumsum(words) - words

        a, z = joined_lines(per_line, line_doc)
        upto = np.r_[0, np.cumsum(per_line)]
        enough = upto[z] - upto[a] >= MIN_WORDS
        self.line_from, self.line_to = a, z = a[enough], z[enough]
        self.line_doc, self.line_words = line_doc[a], upto[z] - upto[a]
        start = upto[a]
        self.line_start = start - begin[self.line_doc]
        first = start + shift[self.line_doc]
        pairs = np.empty(2 * len(first), dtype=np.int64)
        pairs[::2], pairs[1::2] = first, first + self.line_words - SHINGLE_WORDS + 1
        closed = np.append(h, np.uint64(0))

        def over(operation: np.ufunc, x: np.ndarray) -> np.ndarray:
            return operation.reduceat(x, pairs)[::2] if len(pairs) else np.zeros(0, dtype=np.uint64)

        spread = mixed(closed)
        self.line_digest = mixed(over(np.add, spread) ^ self.line_words.astype(np.uint64))
        self.bands = np.zeros((len(first), BANDS), dtype=np.uint64)
        for band in range(BANDS):
            key = np.full(len(first), band + 1, dtype=np.uint64)
            for row in range(ROWS):
                odd = np.uint64((0x9E3779B97F4A7C15 * (2 * (band * ROWS + row) + 1)) & ((1 << 64) - 1))
                key = mixed(key ^ over(np.minimum, spread * odd))
            self.bands[:, band] = key

        at = window_minima(h, np.repeat(np.cumsum(size), size), ANCHOR_WINDOW)
        doc = of[at]
        place = at - shift[doc] - begin[doc]
        whole = place + PASSAGE_WORDS <= words[doc]
        self.passage_doc, self.passage_start = doc[whole], place[whole]
        total = np.zeros(int(whole.sum()), dtype=np.uint64)
        for k, step in enumerate([*range(0, PASSAGE_WORDS - SHINGLE_WORDS, SHINGLE_WORDS), PASSAGE_WORDS - SHINGLE_WORDS]):
            total = mixed(total + h[at[whole] + step] + np.uint64(k + 1))
        self.passage_digest = total

    def features(self) -> np.ndarray:
        """Everything by which paragraphs may meet, as often as it occurs."""
        return np.r_[self.line_digest, self.passage_digest, self.bands.reshape(-1)] >> np.uint64(64 - BITS)


def paragraph_features(raw: list[bytes]) -> np.ndarray:
    return Paragraphs(raw).features()


def meeting_paragraphs(ids: pd.Series, hashes: np.ndarray, raw: list[bytes], found: np.ndarray) -> pd.DataFrame:
    """Paragraphs of a chunk's texts with a digest or band key in ``found``."""
    p = Paragraphs(raw)
    short = np.uint64(64 - BITS)
    lines = np.flatnonzero(among(p.line_digest >> short, found) | among((p.bands >> short).reshape(-1), found).reshape(-1, BANDS).any(axis=1))
    passages = np.flatnonzero(among(p.passage_digest >> short, found))
    text = [x for r in raw for x in r.split(b"\n")]
    a, z = p.line_from[lines], p.line_to[lines]
    doc = np.r_[p.line_doc[lines], p.passage_doc[passages]]
    nothing = [None] * len(passages)
    return pd.DataFrame(
        {
            "doc_id": ids.iloc[doc].to_numpy(), "text_hash": hashes[doc], "start": np.r_[p.line_start[lines], p.passage_start[passages]],
            "words": np.r_[p.line_words[lines], np.full(len(passages), PASSAGE_WORDS)],
            "kind": [*np.where(z - a > 1, "block", "line"), *["passage"] * len(passages)],
            "digest": (np.r_[p.line_digest[lines], p.passage_digest[passages]] >> np.uint64(1)).astype(np.int64),
            "bands": [*(p.bands[lines] >> np.uint64(1)).astype(np.int64), *nothing],
            "line": [*(b"\n".join(text[x:y]).decode("utf-8", "surrogatepass") for x, y in zip(a, z, strict=True)), *nothing],
        }
    )


def line_jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two lines' shingle sets are similar enough."""

    def grams(line: str) -> set[tuple[bytes, ...]]:
        w = line.encode("utf-8", "surrogatepass").lower().split()
        return {tuple(w[i : i + SHINGLE_WORDS]) for i in range(max(len(w) - SHINGLE_WORDS + 1, 1))}

    out = []
    for x, y in zip(a, b, strict=True):
        x, y = grams(x), grams(y)
        both = len(x & y)
        out.append(100 * both >= PERCENT * (len(x) + len(y) - both))
    return pd.Series(out)


def line_tokens(lines: pd.Series) -> pd.DataFrame:
    """Distinct shingle hashes of each line, and their parities."""
    out, bits = [], [np.zeros((0, PARITY_WORDS), dtype=np.int64)]
    for a, b in bounded(lines.str.len(), TOKEN_CHARS):
        h, of = text_shingles(lines.iloc[a:b].tolist())
        cut = np.searchsorted(of, np.arange(b - a + 1))
        own = [np.unique(h[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)]
        bits.append(parities(np.concatenate(own), np.repeat(np.arange(b - a), [len(x) for x in own]), b - a))
        out += [x.astype(np.int64) for x in own]
    return pd.DataFrame({"all": pd.Series(out, dtype=object), "bits": pd.Series([*np.concatenate(bits)], dtype=object)})


def line_sets(text: DataFrame) -> DataFrame:
    """The classes that share enough shingles with others, as ``ngram_join.prefixes`` takes them, and their ``bits``."""
    found = F.pandas_udf(line_tokens, "all array<long>, bits array<long>")("line")
    every = settle(text.select(F.col("key").alias("class"), found.alias("found")).select("class", "found.*"), "line-tokens")
    rows = every.select("class", F.explode("all").alias("token"))
    df = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    sets = rows.join(df, "token").groupBy("class").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    sets = sets.join(every.select("class", F.size("all").alias("n"), "bits"), "class").filter(F.size("t") >= F.ceil(F.col("n") * PERCENT / 100))
    unique = (F.col("n") - F.size("t")).alias("unique")
    return sets.select("class", "n", unique, F.col("t.token").alias("tokens"), F.col("t.df").alias("df"), "bits")


def similar_lines(pairs: DataFrame, text: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose lines are similar enough."""
    both = pairs.join(text.select(F.col("key").alias("a"), F.col("line").alias("x")), "a")
    both = both.join(text.select(F.col("key").alias("b"), F.col("line").alias("y")), "b")
    return both.filter(F.pandas_udf(line_jaccard, "boolean")("x", "y")).select("a", "b")


def line_groups(links: DataFrame) -> DataFrame:
    """``key`` and ``group`` of all line classes with a link."""
    return settle(components(links).select(F.col("node").alias("key"), F.col("component").alias("group")), "line-groups")


def with_groups(rows: DataFrame, of: DataFrame) -> DataFrame:
    """Rows with the ``group`` of their ``key``, which is the key itself where nothing is linked to it."""
    return rows.join(of, "key", "left").withColumn("group", F.coalesce("group", "key"))


def line_links(lines: DataFrame) -> DataFrame:
    """Pairs of similar line classes, ``a`` and ``b`` (keys), that join all which share a bucket and are similar enough."""
    first = settle(lines.groupBy("key").agg(F.min(F.struct("place", "bands"))["bands"].alias("bands")), "line-bands")
    in_band = first.select("key", F.posexplode("bands").alias("band", "bucket"))
    # First one leader for each class: that of its fullest bucket, by an order all bands share, so a family has few leaders.
    order = F.struct(F.xxhash64("key").alias("h"), "key")
    lead = in_band.groupBy("band", "bucket").agg(F.min(order).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = settle(in_band.join(lead, ["band", "bucket"]).select("key", "band", "bucket", "lead", "n"), "line-buckets")
    wanted = met.select("key").distinct()
    text = settle(lines.join(wanted, "key", "left_semi").groupBy("key").agg(F.min("line").alias("line")), "line-texts")
    fullest = F.min(F.struct((-F.col("n")).alias("n"), "lead"))["lead"]["key"]
    pairs = met.filter("key != lead.key").groupBy(F.col("key").alias("a")).agg(fullest.alias("b"))
    links = settle(similar_lines(pairs, text), "line-links")
    # Then a leader in each band, by an order of the band's own, unless both have the same leader by now.
    by_lead = met.select("key", "band", "bucket").join(links.select(F.col("a").alias("key"), F.col("b").alias("under")), "key", "left")
    by_lead = by_lead.withColumn("under", F.coalesce("under", "key"))
    own = F.min(F.struct(F.xxhash64("band", "key"), "key", "under"))
    lead = by_lead.groupBy("band", "bucket").agg(own.alias("lead"), F.min("under").alias("x"), F.max("under").alias("y")).filter("x != y")
    pairs = by_lead.join(lead.select("band", "bucket", "lead"), ["band", "bucket"])
    pairs = pairs.filter("under != lead.under AND under != lead.key AND key != lead.under AND key != lead.key")
    pairs = settle(pairs.select(F.col("key").alias("a"), F.col("lead.key").alias("b")).distinct(), "line-pairs")
    links = links.unionByName(settle(similar_lines(pairs, text), "line-links"))
    of = line_groups(links)
    # Buckets of one group are settled; whatever else collides is in one of several groups.
    apart = with_groups(met.select("key", "band", "bucket"), of)
    several = apart.groupBy("band", "bucket").agg(F.min("group").alias("x"), F.max("group").alias("y")).filter("x != y")
    rest = apart.join(several.select("band", "bucket"), ["band", "bucket"]).select("key").distinct()
    sets = settle(line_sets(text.join(rest, "key", "left_semi")), "line-sets")
    lists = prefixes(sets, PERCENT, more=("bits",)).withColumn("key", F.col("class"))
    lists = mixed_lists(with_groups(lists, of)).drop("main")
    # In a large family most candidates are similar, so leaders join most of it, and few pairs of different groups are left.
    found = several_leader_pairs(lists, LEADERS, PERCENT)
    links = links.unionByName(settle(linked(found, sets, PERCENT), "line-links"))
    lists = mixed_lists(with_groups(lists.drop("group"), line_groups(links)))
    return links.unionByName(settle(linked(main_pairs(lists, PERCENT, ("bits",)), sets, PERCENT), "line-links"))


def duplicate_paragraphs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Every paragraph that has a repeat: ``doc_id``, ``text_hash``, ``start``, ``words`` (in words), ``kind``,
    ``cluster_doc_id`` and ``cluster_start`` of the cluster's earliest paragraph, and ``removed``."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    ranges = ranges or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = second_look(texts, paragraph_features, meeting_paragraphs, UNIT, ranges)
    rows = rows.withColumn("key", F.struct((F.col("kind") == "passage").alias("passage"), "words", "digest"))
    rows = settle(rows.withColumn("place", F.struct("doc_id", "text_hash", "start")), "paragraphs")
    of = components(line_links(rows.filter("kind != 'passage'")))
    of = of.select(F.col("node").alias("key"), F.col("component").alias("cluster"))
    # A class's earliest place and size first; clusters then have a row per class, not per paragraph.
    classes = rows.groupBy("key").agg(F.min("place").alias("first"), F.count_distinct("place").alias("n"))
    classes = classes.join(of, "key", "left").withColumn("cluster", F.coalesce("cluster", "key"))
    classes = settle(classes.filter((F.col("n") > 1) | (F.col("cluster") != F.col("key")) | ~F.col("key.passage")), "classes")
    clusters = classes.groupBy("cluster").agg(F.min("first").alias("first"), F.sum("n").alias("members")).filter("members > 1")
    found = classes.select("key", "cluster").join(clusters, "cluster").select("key", F.col("first").alias("earliest"))
    out = rows.select("key", "place", "kind", "words").join(found, "key")
    return out.select(
        "place.*", "words", "kind", F.col("earliest.doc_id").alias("cluster_doc_id"), F.col("earliest.start").alias("cluster_start"),
        (F.col("place") != F.col("earliest")).alias("removed"),
    ).distinct()
