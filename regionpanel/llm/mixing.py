"""Mix sources to target weights: fixed-length blocks, multinomial draws per output shard, permuted block indexes.

Only DataFrame functions run here. Every source is a stream of words, cut into blocks of ``block_words``. A source
whose target is ``t`` words gives ``t // size`` whole passes over its blocks and the first part of one more, each
pass in a pseudorandom order of its own. Output slots draw their source one by one, which makes the counts of a
shard multinomial; what a source was drawn too often is handed to those drawn too seldom, so totals are exact.

Defined results: a null text has no words; null is a source of its own; a source without words has target 0; rows
alike in id and text are laid out one after the other; a very long text lies over many blocks; an empty table gives an
empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_hash, settle, word_count

#: A word with the blanks before it; joined again the pieces give the text up to its last word.
SPACED = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
ROUNDS = 24
BINS = 4096
BLOCK_WORDS = 1024
SEED = 17


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", carry: bool = False) -> DataFrame:
    """One row per document: id, text hash, source, its key without null, and the number of words.

    With ``carry`` the text comes along as ``text`` and all other columns as the struct ``doc``.
    """
    t, s = F.col(text), F.col(source)
    along = [t.alias("text"), F.struct(*[c for c in docs.columns if c != text]).alias("doc")] if carry else []
    return docs.select(
        *along,
        F.col(doc_id).alias("doc_id"),
        row_hash(t).alias("text_hash"),
        s.alias("source"),
        F.when(s.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), s)).alias("source_key"),
        word_count(t).alias("size"),
    )


def number(*parts: Column) -> Column:
    """48 bits out of the MD5 of the parts, the same in every engine."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def source_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``share`` of all sizes split by ``weight``, at most ``most`` times a source's size; the excess goes to the rest.

    Raising one level until the capped and the proportional parts make up the total gives what resharing the excess
    again and again ends in. Each step brings two sums to the driver.
    """
    sources = settle(sources, "sources")
    cap = F.col("source_size") * F.lit(float(most))
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = share * (total or 0) / weights if weights else 0.0
    while True:
        free = cap > F.lit(level) * F.col("weight")
        held, rest = sources.agg(F.sum(F.when(~free, cap)), F.sum(F.when(free, F.col("weight")))).first()
        raised = max(level, (share * (total or 0) - (held or 0.0)) / rest) if rest else level
        if raised == level:
            return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")).cast("double"))
        level = raised


def lay_out(rows: DataFrame, chunk_rows: int = 10_000) -> DataFrame:
    """Add ``offset``: the number of words of the same source before the row, in a hashed order.

    Sources are cut into chunks of the hash's range, so the running sums of a source with most rows are spread as well.
    """
    chunks = max(1, -(-rows.count() // chunk_rows))
    rows = rows.withColumn("_hash", number(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("_chunk", F.floor(F.col("_hash") / F.lit(float(1 << 48)) * chunks))
    sums = rows.groupBy("source_key", "_chunk").agg(F.sum("size").alias("_sum"))
    upto = Window.partitionBy("source_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("source_key", "_chunk", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("source_key", "_chunk").orderBy("_hash", "doc_id", "text_hash")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    laid = rows.join(base, ["source_key", "_chunk"]).withColumn("offset", F.col("_base") + before)
    return laid.drop("_hash", "_chunk", "_base")


def quotas(sources: DataFrame, block_words: int) -> DataFrame:
    """Blocks and slots of a source: ``full`` whole blocks, ``blocks`` with the short last one, ``quota`` slots."""
    size, b = F.col("source_size"), F.lit(block_words)
    s = sources.withColumn("take", F.round("target").cast("long"))
    s = s.withColumn("full", F.expr(f"source_size div {block_words}")).withColumn("blocks", F.ceil(size / b))
    s = s.withColumn("passes", F.when(size > 0, F.expr("take div source_size")).otherwise(F.lit(0)))
    s = s.withColumn("left", F.col("take") - F.col("passes") * size)
    return s.withColumn("quota", (F.col("passes") * F.col("blocks") + F.ceil(F.col("left") / b)).cast("long"))


def draws(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """A source and its running number ``k`` for every output slot (``out_shard``, ``slot``).

    Windows without a key run over one row per source only.
    """
    q = sources.filter("quota > 0")
    before = Window.orderBy("source_key").rowsBetween(Window.unboundedPreceding, -1)
    q = settle(q.withColumn("first", F.coalesce(F.sum("quota").over(before), F.lit(0))), "quotas")
    slots = int(q.agg(F.sum("quota")).first()[0] or 0)
    width = max(1, -(-slots // BINS))
    bins = q.select(
        "source_key", "first", "quota",
        F.explode(F.expr(f"sequence(first div {width}, (first + quota - 1) div {width})")).alias("bin"),
    )
    g = F.col("id")
    drawn = q.sparkSession.range(slots).select(
        F.expr(f"id div {shard_slots}").alias("out_shard"),
        (g % shard_slots).alias("slot"),
        (number(F.lit(seed), g) % max(slots, 1)).alias("v"),
    )
    drawn = drawn.withColumn("bin", F.expr(f"v div {width}")).join(bins, "bin")
    drawn = drawn.filter("v >= first and v < first + quota").select("out_shard", "slot", "source_key", "quota")
    # Multinomial counts of a shard, and how often earlier shards have drawn the source.
    counts = drawn.groupBy("source_key", "out_shard").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source_key").orderBy("out_shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = Window.partitionBy("source_key", "out_shard").orderBy("slot")
    drawn = drawn.join(counts, ["source_key", "out_shard"])
    drawn = settle(drawn.withColumn("k", F.col("earlier") + F.row_number().over(inside) - 1).drop("earlier"), "draws")
    got = drawn.groupBy("source_key").agg(F.count(F.lit(1)).alias("got"))
    bal = q.select("source_key", "quota").join(got, "source_key", "left").fillna(0, ["got"])
    bal = bal.withColumn("over", F.greatest(F.col("got") - F.col("quota"), F.lit(0)))
    bal = bal.withColumn("under", F.greatest(F.col("quota") - F.col("got"), F.lit(0)))
    bal = bal.select(
        "source_key", "got", "under",
        F.coalesce(F.sum("over").over(before), F.lit(0)).alias("over_first"),
        F.coalesce(F.sum("under").over(before), F.lit(0)).alias("under_first"),
    )
    kept = drawn.filter("k < quota").select("out_shard", "slot", "source_key", "k")
    extra = drawn.filter("k >= quota").join(bal.select("source_key", "over_first"), "source_key")
    extra = extra.select("out_shard", "slot", (F.col("over_first") + F.col("k") - F.col("quota")).alias("at"))
    short = bal.filter("under > 0").select(
        "source_key", "got", "under_first", F.explode(F.expr("sequence(0L, under - 1)")).alias("i")
    )
    short = short.select((F.col("under_first") + F.col("i")).alias("at"), "source_key", (F.col("got") + F.col("i")).alias("k"))
    return kept.unionByName(extra.join(short, "at").select("out_shard", "slot", "source_key", "k"))


def permuted(x: Column, n: Column, seed: int, *key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1 by swap-or-not rounds, another one for each ``key``."""

    def step(at: Column, r: Column) -> Column:
        other = F.pmod(number(F.lit(seed), *key, r) % n - at, n)
        swap = number(F.lit(seed + 1), *key, r, F.greatest(at, other)) % 2 == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), step)


def slot_blocks(drawn: DataFrame, sources: DataFrame, block_words: int, seed: int) -> DataFrame:
    """The block of every slot, and how many words the slot takes of it."""
    s = sources.select("source_key", "source_size", "full", "blocks", "passes", "left")
    d = drawn.join(s, "source_key").withColumn("pass", F.expr("k div blocks"))
    d = d.withColumn("_i", F.col("k") % F.col("blocks"))
    # The short block ends every pass, so the words before a slot are known without a sum.
    at = permuted(F.col("_i"), F.col("full"), seed, F.col("source_key"), F.col("pass"))
    d = d.withColumn("block", F.when(F.col("_i") < F.col("full"), at).otherwise(F.col("full")))
    rest = F.least(F.lit(block_words), F.col("left") - F.col("_i") * block_words)
    return d.select(
        "out_shard", "slot", "source_key", "pass", "block",
        F.when(F.col("pass") < F.col("passes"), F.lit(block_words)).otherwise(rest).cast("long").alias("limit"),
    )


def pieces(laid: DataFrame, block_words: int, text: str | None = None) -> DataFrame:
    """The part of every document in every block it reaches; with ``text``, the words themselves and their blanks."""
    b = block_words
    reach = F.expr(f"sequence(offset div {b}, (offset + size - 1) div {b})")
    start = lambda i: F.greatest(i * b - F.col("offset"), F.lit(0))
    length = lambda i: F.least(F.col("offset") + F.col("size"), (i + 1) * b) - F.greatest(F.col("offset"), i * b)
    rows = laid.filter("size > 0")
    fields = lambda i: [i.alias("block"), start(i).alias("start"), length(i).alias("length")]
    if text is not None:
        rows = rows.withColumn("_words", F.regexp_extract_all(F.col(text), F.lit(SPACED), F.lit(0)))
        part = lambda i: F.array_join(F.slice("_words", (start(i) + 1).cast("int"), length(i).cast("int")), "")
        made = F.transform(reach, lambda i: F.struct(*fields(i), part(i).alias("piece")))
    else:
        made = F.transform(reach, lambda i: F.struct(*fields(i)))
    rows = rows.withColumn("_part", F.explode(made)).withColumn("block", F.col("_part.block"))
    rows = rows.withColumn("in_block", F.greatest(F.col("offset") - F.col("block") * b, F.lit(0)))
    rows = rows.withColumn("start", F.col("_part.start")).withColumn("length", F.col("_part.length"))
    rows = rows.withColumn("piece", F.col("_part.piece")) if text is not None else rows
    return rows.drop("_part", "_words", *([text] if text is not None else []))


def mix(
    laid: DataFrame, sources: DataFrame, text: str | None = None, block_words: int = BLOCK_WORDS, shard_slots: int = 1024, seed: int = SEED
) -> DataFrame:
    """Rows of the mix: output shard and slot, the block in it, and the part of a document with ``words`` taken.

    ``laid`` comes from ``lay_out``, ``sources`` (source_key, source_size, target) from ``targets``. ``text`` names a
    column of ``laid`` whose part is returned as ``piece``; further columns of ``laid`` come along.
    """
    q = settle(quotas(sources, block_words), "mix-sources")
    slots = slot_blocks(draws(q, shard_slots, seed), q, block_words, seed)
    out = pieces(laid, block_words, text).join(slots, ["source_key", "block"])
    out = out.withColumn("words", F.least("length", F.col("limit") - F.col("in_block"))).filter("words > 0")
    if text is not None:
        cut = F.array_join(F.slice(F.regexp_extract_all("piece", F.lit(SPACED), F.lit(0)), 1, F.col("words").cast("int")), "")
        out = out.withColumn("piece", F.when(F.col("words") < F.col("length"), cut).otherwise(F.col("piece")))
    return out.drop("limit", "length")
