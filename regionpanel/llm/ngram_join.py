"""Exact Jaccard join on word shingles with adaptive multi-match prefixes, and the groups its links make.

The set of a document is its distinct shingles; documents of equal sets are one class. All sets share one order of
tokens, rare first. Two sets that are similar enough have at least ``l`` tokens in common among the first
``|x| - need + l`` of each, for every ``l``, where ``need`` is what the pair must have in common. A class takes the ``l``
with the least estimated cost: reading longer posting lists against checking fewer candidates. A pair is checked, on
whole sets, if it shares as many prefix tokens as the smaller ``l`` of the two asks for.

How often a token occurs is counted over all documents: map tasks send sorted, packed hashes of the distinct tokens of
some thousand documents (a chunk) to the task of their hash range, and get back those that other sets have as well. A
set that shares fewer than ``need`` of its tokens with the rest cannot have a link and ends there.

Links are needed for groups, not as a list. Members of a posting list are first checked against one leader of the list,
a few rounds with different leaders; then only pairs of different groups are left, and every one of those that shares
enough prefix tokens is checked. So a family of thousands of near copies costs rows in proportion to its size, and no
link between different texts is lost.

Defined results: no words or no text: empty set, linked with nothing, its own group; fewer words than a shingle has:
one shingle of all of them; equal sets are linked; rows that repeat an id are nodes of their own with that id; null ids
are never the smallest of a group unless it has no other; a very long text is a chunk of its own and all its shingles count;
an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, row_hash, settle, word_count
from .components import components
from .shingles import BITS, Words, mixed, pack, shingles, unpack

PERCENT = 75
#: Words of a chunk of documents; what a task holds in memory follows from it.
CHUNK_WORDS = 250_000
#: Longest prefix extension that is weighed, and the cost of checking a pair in posting entries.
MOST_MATCHES = 6
CHECK_COST = 40.0
LEADER_ROUNDS = 3
#: Words of 64 bits that stand for a whole set where a pair is weighed.
PARITY_WORDS = 4


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Fewest tokens that a set of ``n`` has in common with any set it is linked to."""
    return -(-percent * n // 100)


class Chunk:
    """Distinct token sets of some documents.

    ``tokens``: the distinct tokens, sorted; ``df``: sets that have each; ``first``, ``places``: the sets as places in
    ``tokens``; ``size``, ``key``: tokens and identity of a set; ``of``: the set of each document, -1 for empty ones.
    """

    def __init__(self, texts: list[str | None]):
        words = Words([t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts])
        h, of = shingles(words.hashes, words.counts)
        docs = texts
        order = np.lexsort((h, of))
        h, of = h[order], of[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
        h, of = h[new], of[new]
        size = np.bincount(of, minlength=len(docs)).astype(np.int64)
        # The identity of a set does not depend on an order: two sums of spread tokens, cut to what a long holds.
        start = np.r_[0, np.cumsum(size)[:-1]]
        full = np.flatnonzero(size)
        key = np.zeros(len(docs), dtype=np.uint64)
        if len(full):
            key[full] = mixed(np.add.reduceat(mixed(h + np.uint64(1)), start[full]) ^ size[full].astype(np.uint64))
        key >>= np.uint64(1)
        _, one, same = np.unique(key[full], return_index=True, return_inverse=True)
        self.of = np.full(len(docs), -1, dtype=np.int64)
        self.of[full] = same
        rep = full[one]
        self.key, self.size = key[rep].astype(np.int64), size[rep]
        self.doc_key, self.doc_size = key.astype(np.int64), size
        keep = np.zeros(len(docs), dtype=bool)
        keep[rep] = True
        mine = keep[of]
        # Sets in the order of their keys, tokens ascending inside each.
        rank = np.zeros(len(docs), dtype=np.int64)
        rank[rep] = np.arange(len(rep))
        by = np.argsort(rank[of[mine]], kind="stable")
        self.tokens, places = np.unique(h[mine][by], return_inverse=True)
        self.places = places
        self.df = np.bincount(places, minlength=len(self.tokens))
        self.first = np.r_[0, np.cumsum(self.size)]
        self.id = int(xxhash.xxh3_64_intdigest(np.r_[self.doc_key, self.doc_size].tobytes()) >> 1)


def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, Chunk]]:
    for batch in batches:
        sizes = [len(t) // 5 + 1 if isinstance(t, str) else 1 for t in batch["text"]]
        for a, b in bounded(sizes, CHUNK_WORDS):
            part = batch.iloc[a:b]
            yield part, Chunk([t if isinstance(t, str) else None for t in part["text"]])


def token_ranges(tokens: np.ndarray, ranges: int) -> np.ndarray:
    """Where each hash range begins in sorted tokens."""
    edges = (np.arange(ranges + 1, dtype=object) * (1 << BITS) // ranges).astype(np.uint64)
    return np.searchsorted(tokens, edges)


def repeated_tokens(texts: DataFrame, ranges: int) -> DataFrame:
    """For every chunk and hash range the tokens that more than one set has: ``chunk``, ``at``, ``token``, ``df`` packed.

    A token reaches its range once per chunk with a count, so a token that most documents have costs one entry for
    some thousand of them.
    """

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, c in chunks(batches):
            cut = token_ranges(c.tokens, ranges)
            rows = [(i, c.id, pack(c.tokens[a:b]), pack(c.df[a:b]), a) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
            yield pd.DataFrame(rows, columns=["range", "chunk", "tokens", "df", "first"])

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("chunk")
        tokens = [unpack(x) for x in rows["tokens"]]
        counts = [unpack(x).astype(np.int64) for x in rows["df"]]
        every, place = np.unique(np.concatenate(tokens), return_inverse=True)
        df = np.bincount(place, weights=np.concatenate(counts), minlength=len(every)).astype(np.int64)
        out, at = [], 0
        for chunk, first, mine in zip(rows["chunk"], rows["first"], tokens, strict=True):
            own = df[place[at : at + len(mine)]]
            at += len(mine)
            hit = np.flatnonzero(own > 1)
            if len(hit):
                out.append((chunk, None, None, pack(hit + first), pack(mine[hit]), pack(own[hit]), None))
        return pd.DataFrame(out, columns=["chunk", "sizes", "keys", "at", "token", "df", "places"])

    parts = texts.mapInPandas(sent, "range int, chunk long, tokens binary, df binary, first long")
    return parts.groupBy("range").applyInPandas(
        counted, "chunk long, sizes binary, keys binary, at binary, token binary, df binary, places binary"
    )


FOUND = ["doc_id", "text_hash", "class", "n", "unique", "tokens", "df"]


def members_and_sets(texts: DataFrame, percent: int, ranges: int) -> DataFrame:
    """Two kinds of rows. Every document: ``doc_id``, ``text_hash``, ``class`` (null for empty sets), ``n``. Every class
    that shares enough tokens with others, once per chunk: ``class``, ``n``, ``unique``, ``tokens`` rare first, ``df``."""

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, c in chunks(batches):
            d = c.places.astype(np.int64)
            inner = np.ones(len(d), dtype=bool)
            inner[c.first[:-1]] = False
            d[inner] -= c.places[np.flatnonzero(inner) - 1]
            ids = part["doc_id"].astype("Int64")
            docs = np.r_[ids.notna().to_numpy().astype(np.int64), ids.fillna(0).astype("int64").to_numpy(), part["text_hash"].to_numpy().astype("int64"), c.of]
            row = (c.id, pack(c.size), c.key.tobytes(), None, None, docs.astype(np.int64).tobytes(), pack(d))
            yield pd.DataFrame([row], columns=["chunk", "sizes", "keys", "at", "token", "df", "places"])

    def look(rows: pd.DataFrame) -> pd.DataFrame:
        heads, hits = rows[rows["sizes"].notna()], rows[rows["at"].notna()]
        head = heads.iloc[0]
        size = unpack(head["sizes"]).astype(np.int64)
        keys = np.frombuffer(head["keys"], dtype=np.int64)
        # Chunks alike in every row share the sets; the documents of each are listed.
        out = []
        for text in heads["df"]:
            known, ids, hashes, of = np.frombuffer(text, dtype=np.int64).reshape(4, -1)
            out += [
                (i if k else None, h, keys[c] if c >= 0 else None, size[c] if c >= 0 else 0, None, None, None)
                for k, i, h, c in zip(known.tolist(), ids.tolist(), hashes.tolist(), of.tolist(), strict=True)
            ]
        if len(hits):
            d = unpack(head["places"]).astype(np.int64)
            first = np.r_[0, np.cumsum(size)]
            total = np.cumsum(d)
            places = total - np.repeat(total[first[:-1]] - d[first[:-1]], size)
            at = np.concatenate([unpack(x) for x in hits["at"]]).astype(np.int64)
            width = max(int(places.max()), int(at.max())) + 1
            df, token = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
            df[at] = np.concatenate([unpack(x) for x in hits["df"]]).astype(np.int64)
            token[at] = np.concatenate([unpack(x) for x in hits["token"]]).astype(np.int64)
            shared = df[places] > 1
            count = np.add.reduceat(shared, first[:-1]).astype(np.int64)
            for i in np.flatnonzero(count >= needed(size, percent)):
                p = places[first[i] : first[i + 1]]
                p = p[df[p] > 1]
                p = p[np.lexsort((token[p], df[p]))]
                out.append((None, None, keys[i], size[i], size[i] - len(p), token[p], df[p]))
        columns = list(zip(*out, strict=True)) or [[] for _ in FOUND]
        # Column by column: pandas would make floats of long numbers beside nulls.
        whole = {c: pd.array(list(x), dtype="Int64") for c, x in zip(FOUND[:5], columns, strict=False)}
        return pd.DataFrame(whole | {c: pd.Series(list(x), dtype=object) for c, x in zip(FOUND[5:], columns[5:], strict=True)})

    rows = texts.mapInPandas(headers, "chunk long, sizes binary, keys binary, at binary, token binary, df binary, places binary")
    rows = rows.unionByName(repeated_tokens(texts, ranges))
    out = "doc_id long, text_hash long, class long, n long, unique long, tokens array<long>, df array<long>"
    return rows.groupBy("chunk").applyInPandas(look, out)


def prefixes(sets: DataFrame, percent: int, most: int = MOST_MATCHES, more: tuple[str, ...] = ()) -> DataFrame:
    """``token``, ``class``, ``n``, ``shared``, ``matches``, ``pos``: the prefix of every class, the matches it asks for and
    the token's place in the order; ``shared`` is the number of the class's tokens that other sets have. Columns ``more``
    of the sets go along.

    Tokens that no other set has stand first in the order and are left out: they match nothing. With ``l`` matches the
    prefix holds ``l - 1`` more tokens; a pair that shares ``l`` of them uses up ``l`` posting entries, so entries
    divided by ``l`` bound the candidates. Entries are estimated for partners of the same size, which share more and so
    look at fewer tokens than the prefix, kept for partners of any size, holds.
    """
    base = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.col("unique")
    same = F.col("n") - F.ceil(F.col("n") * 2 * percent / (100 + percent)) + 1 - F.col("unique")
    rows = sets.withColumn("base", base.cast("int")).withColumn("same", F.greatest(same, F.lit(0)).cast("int"))

    def cost(m: int) -> Column:
        entries = F.aggregate(F.slice("df", F.lit(1), F.col("same") + (m - 1)), F.lit(0).cast("long"), lambda s, x: s + x - 1)
        return F.when(F.col("base") + (m - 1) <= F.size("tokens"), entries * (1 + CHECK_COST / m))

    # A struct with a null cost would come first, so lengths past the end of the set are left out.
    costs = F.filter(F.array(*[F.struct(cost(m).alias("cost"), F.lit(m).alias("m")) for m in range(1, most + 1)]), lambda x: x["cost"].isNotNull())
    best = F.array_min(costs)["m"]
    rows = rows.withColumn("matches", F.coalesce(best, F.lit(1)))
    rows = rows.withColumn("prefix", F.slice("tokens", F.lit(1), F.col("base") + F.col("matches") - 1))
    rows = rows.withColumn("shared", F.col("n") - F.col("unique"))
    rows = rows.select("class", "n", "shared", "unique", "matches", *more, F.posexplode("prefix").alias("at", "token"))
    return rows.select("token", "class", "n", "shared", "matches", (F.col("unique") + F.col("at") + 1).alias("pos"), *more)


def may_link(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """Whether a shared prefix token counts for a pair.

    Similar sets of these sizes have ``common`` tokens in common, so neither may have fewer that occur elsewhere, and
    they share ``m`` tokens among the first ``n - common + m`` of each, which is less than the prefix that any partner
    could need. Sets with a ``bits`` (see ``parities``) differ in at least as many tokens as these do in bits.
    """
    common = F.ceil((a["n"] + b["n"]) * percent / (100 + percent))
    asked = F.least(a["matches"], b["matches"])
    inside = [x["pos"] <= x["n"] - common + asked for x in (a, b)]
    may = (F.least(a["shared"], b["shared"]) >= common) & inside[0] & inside[1]
    if "bits" not in a:
        return may
    differ = sum((F.bit_count(a["bits"][i].bitwiseXOR(b["bits"][i])) for i in range(PARITY_WORDS)), F.lit(0))
    return may & (a["n"] + b["n"] - differ >= 2 * common)


def enough(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether the rows of a pair, one for each shared token that counts, are as many as the pair's smaller ``matches``."""
    return F.count(F.lit(1)) >= F.max(F.least(a["matches"], b["matches"]))


def side(prefix: str = "", more: tuple[str, ...] = ()) -> dict[str, Column]:
    return {c: F.col(prefix + c) for c in ("n", "shared", "matches", "pos", *more)}


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole sets are similar enough."""
    a = sets.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    rows = pairs.select("a", "b").join(a, "a").join(b, "b").withColumn("both", both)
    return rows.filter(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def leader_pairs(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """For every class not in its leader's group the leader it shares most prefix tokens with: ``a``, ``b``."""
    # First the set with the fewest tokens of its own leads, as the one that copies were made from; then any.
    order = F.when(F.lit(turn) == 0, F.floor((F.col("n") - F.col("shared")) * 1000 / F.col("n"))).otherwise(0)
    order = F.struct(order.alias("o"), F.xxhash64(F.lit(turn), "class").alias("h"), "class", "n", "shared", "matches", "pos", "group")
    lead = lists.groupBy("token").agg(F.min(order).alias("lead"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    rows = lists.join(lead.select("token", "lead"), "token")
    rows = rows.filter((F.col("group") != F.col("lead.group")) & may_link(side(), side("lead."), percent))
    rows = rows.groupBy(F.col("class").alias("a"), F.col("lead.class").alias("b")).agg(
        enough(side(), side("lead.")).alias("ok"), F.count(F.lit(1)).alias("tokens")
    )
    best = rows.filter("ok").groupBy("a").agg(F.max(F.struct("tokens", "b")).alias("best"))
    return best.select("a", F.col("best.b").alias("b"))


def parities(tokens: np.ndarray, of: np.ndarray, sets: int) -> np.ndarray:
    """For each set whether an odd or even number of its distinct tokens falls on each of ``64 * PARITY_WORDS`` bits.

    A token that only one of two sets has turns one bit, so the bits in which they differ are no more than such tokens.
    """
    at = mixed(tokens)
    bits = np.zeros(sets * PARITY_WORDS, dtype=np.uint64)
    word = (at >> np.uint64(6)) % np.uint64(PARITY_WORDS)
    np.bitwise_xor.at(bits, of * PARITY_WORDS + word.astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return bits.reshape(sets, PARITY_WORDS).view(np.int64)


def mixed_lists(lists: DataFrame) -> DataFrame:
    """Posting lists that several groups are in, with the largest of them as ``main``."""
    sizes = lists.groupBy("token", "group").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("token").agg(F.max(F.struct("c", "group"))["group"].alias("main"), F.count(F.lit(1)).alias("groups"))
    return settle(lists.join(main.filter("groups > 1").drop("groups"), "token"), "posting-lists")


def several_leader_pairs(lists: DataFrame, leaders: int, percent: int) -> DataFrame:
    """Candidate pairs of different groups of the members of each posting list with some of them: ``a``, ``b``."""
    order = Window.partitionBy("token").orderBy(F.xxhash64("class"), "class")
    lead = lists.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= leaders)
    a = [F.col(c).alias(f"a_{c}") for c in ("class", "n", "shared", "matches", "pos", "group", "bits")]
    pairs = lead.select("token", *a).join(lists, "token")
    pairs = pairs.filter((F.col("a_group") != F.col("group")) & may_link(side("a_", ("bits",)), side("", ("bits",)), percent))
    # One way round at a time: where both lead, the token would count twice.
    pairs = pairs.groupBy("a_class", "class").agg(enough(side("a_"), side()).alias("ok")).filter("ok")
    return pairs.select(F.least("a_class", "class").alias("a"), F.greatest("a_class", "class").alias("b")).distinct()


def cross_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs of different groups: ``a``, ``b``.

    In each posting list the largest group meets the members of the others, never itself, so the rows follow the
    members that are not yet in it.
    """
    return main_pairs(mixed_lists(lists), percent)


def main_pairs(rows: DataFrame, percent: int, more: tuple[str, ...] = ()) -> DataFrame:
    """The candidate pairs of ``cross_pairs`` from posting lists with their largest group as ``main``."""
    few = rows.filter("group != main")
    a = [F.col(c).alias(f"a_{c}") for c in ("class", "n", "shared", "matches", "pos", "group", *more)]
    pairs = few.select("token", *a).join(rows, "token")
    other = (F.col("group") == F.col("main")) | (F.col("a_class") < F.col("class"))
    pairs = pairs.filter((F.col("a_group") != F.col("group")) & other & may_link(side("a_", more), side("", more), percent))
    pair = [F.least("a_class", "class").alias("a"), F.greatest("a_class", "class").alias("b")]
    return pairs.groupBy(*pair).agg(enough(side("a_"), side()).alias("ok")).filter("ok").select("a", "b")


def grouped(lists: DataFrame, links: DataFrame | None) -> DataFrame:
    """Posting lists with the ``group`` of each class by the links found so far."""
    if links is None:
        return lists.withColumn("group", F.col("class"))
    of = components(links).select(F.col("node").alias("class"), F.col("component").alias("group"))
    return lists.join(of, "class", "left").withColumn("group", F.coalesce("group", "class"))


def jaccard_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, ranges: int | None = None) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` (the group's smallest id) and ``group`` of every document.

    ``ranges`` is the number of hash ranges for counting tokens, four times the shuffle partitions by default.
    """
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    seen = settle(members_and_sets(texts, percent, ranges), "members-and-sets")
    sets = settle(seen.filter("tokens IS NOT NULL").select("class", "n", "unique", "tokens", "df").dropDuplicates(["class"]), "sets")
    lists = settle(prefixes(sets, percent), "prefixes")
    links = None
    for turn in range(LEADER_ROUNDS):
        found = settle(linked(leader_pairs(grouped(lists, links), turn, percent), sets, percent), "links")
        links = found if links is None else links.unionByName(found)
    rest = settle(linked(cross_pairs(grouped(lists, links), percent), sets, percent), "links")
    of = components(links.unionByName(rest)).select(F.col("node").alias("class"), F.col("component").alias("group"))
    members = seen.filter("tokens IS NULL").select("doc_id", "text_hash", "class", "n")
    members = settle(members.join(of, "class", "left").withColumn("group", F.coalesce("group", "class")), "grouped")
    least = members.filter("n > 0").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    out = members.join(least, "group", "left")
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "group")


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest id of every group, and all rows without words."""
    groups = jaccard_groups(docs, doc_id, text, percent).filter("n_shingles > 0")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    stay = groups.groupBy("group").agg(F.min(place).alias("p")).select(F.col("p.doc_id").alias("_id"), F.col("p.text_hash").alias("_hash"))
    rows = docs.withColumn("_own", F.col(doc_id).cast("long")).withColumn("_of", row_hash(F.col(text)))
    words = rows.filter(word_count(F.col(text)) > 0)
    words = words.join(stay, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_hash")), "left_semi")
    words = words.dropDuplicates(["_own", "_of"])
    return words.unionByName(rows.filter(word_count(F.col(text)) == 0)).select(*docs.columns)
