"""Fill-in-the-middle: cut texts into prefix, middle and suffix and write the middle last.

A text is a row of units (code points by default, or what a pattern matches from left to right). Its UTF-8 bytes lie in
blocks of a fixed size; a Fenwick tree over the blocks holds how many units and how many code points begin in each. A
cut after k units is found by descending the tree in powers of two, and then by matching units inside one block.

Defined results: a null text is empty; an empty text, and one that contains a sentinel, stays plain; very long texts take
eight bytes a block on top of their own; rows alike give rows alike, since the cuts follow from seed and id, and a null
id counts as an empty string; an empty table gives no rows; other columns stay, those of the names added give way.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit is a code point: a leading byte and the bytes that go on. Other patterns over UTF-8 bytes may be given.
CODE_POINT = rb"[\x00-\x7f\xc0-\xff][\x80-\xbf]*"
SENTINELS = ("<P>", "<S>", "<M>")
#: Bytes of a block.
BLOCK = 4096
#: Of 100 texts so many become infills, and so many of those begin with the suffix.
RATE, SUFFIX_FIRST = 90, 20
CUT = ["n", "prefix_chars", "prefix_bytes", "middle_chars", "middle_bytes"]
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


class Fenwick:
    """Sums over blocks of several counts at once; row i of ``tree`` covers the lowbit(i) blocks that end with block i."""

    def __init__(self, counts: np.ndarray):
        self.blocks = len(counts)
        self.tree = np.vstack([np.zeros((1, counts.shape[1]), dtype=np.int64), counts])
        for i in range(1, self.blocks + 1):
            above = i + (i & -i)
            if above <= self.blocks:
                self.tree[above] += self.tree[i]
        self.top = 1 << max(self.blocks.bit_length() - 1, 0)

    def total(self) -> np.ndarray:
        out, i = np.zeros(self.tree.shape[1], dtype=np.int64), self.blocks
        while i:
            out += self.tree[i]
            i -= i & -i
        return out

    def find(self, k: int) -> tuple[int, np.ndarray]:
        """The block in which the k-th unit (from 1) begins, and the counts of the blocks before it."""
        at, before, step = 0, np.zeros(self.tree.shape[1], dtype=np.int64), self.top
        while step:
            if at + step <= self.blocks and before[0] + self.tree[at + step, 0] < k:
                at += step
                before = before + self.tree[at]
            step >>= 1
        return at, before


class Blocks:
    """A text in blocks, with the places where units begin in each."""

    def __init__(self, text: bytes, unit: bytes = CODE_POINT, block: int = BLOCK):
        self.text, self.block, self.unit = text, block, re.compile(unit, re.DOTALL)
        self.leads = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
        edges = np.arange(0, len(text), block)
        chars = np.add.reduceat(self.leads, edges, dtype=np.int64) if len(text) else np.zeros(0, dtype=np.int64)
        if unit == CODE_POINT:
            units, self.first = chars, None
        else:
            starts = np.fromiter((m.start() for m in self.unit.finditer(text)), dtype=np.int64)
            units = np.bincount(starts // block, minlength=len(edges)).astype(np.int64)
            # Where the first unit of each block begins; blocks without one are never asked for.
            self.first = starts[np.minimum(np.cumsum(units) - units, max(len(starts) - 1, 0))] if len(starts) else starts
        self.tree = Fenwick(np.stack([units, chars], axis=1))
        self.n = int(self.tree.total()[0])

    def end_of(self, k: int) -> tuple[int, int]:
        """Bytes and code points from the beginning of the text to the end of its k-th unit."""
        if k <= 0:
            return 0, 0
        b, (units, chars) = self.tree.find(k)
        begin, more = b * self.block, k - int(units)
        if self.first is None:
            # The next code point begins where this one ends; the last one of a block may reach into the next.
            next_ = np.flatnonzero(self.leads[begin : begin + self.block + 4])
            end = begin + int(next_[more]) if more < len(next_) else len(self.text)
        else:
            found = self.unit.finditer(self.text, int(self.first[b]))
            end = next(islice(found, more - 1, None)).end()
        return end, int(chars) + int(np.count_nonzero(self.leads[begin:end]))


def cuts(text: bytes, a: int, b: int, unit: bytes = CODE_POINT, block: int = BLOCK) -> tuple[int, int, int, int, int]:
    """Units of a text, then code points and bytes of its prefix, code points and bytes of its middle; the cuts are
    after ``a`` and ``b`` modulo n + 1 units, the smaller first."""
    blocks = Blocks(text, unit, block)
    (at, chars), (end, upto) = sorted(blocks.end_of(x % (blocks.n + 1)) for x in (a, b))
    return blocks.n, chars, at, upto - chars, end - at


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2 ** 32 out of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
    unit: bytes = CODE_POINT, block: int = BLOCK, sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """``docs`` with ``n`` (units), ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars`` and ``output``.

    Python sees the bytes of a text and gives back where to cut; Spark cuts and joins the text itself.
    """

    def find(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
        rows = [cuts(t, a, b, unit, block) for t, a, b in zip(texts, first, second, strict=True)]
        return pd.DataFrame(rows, columns=CUT, dtype="int64")

    p, s, m = (F.lit(x) for x in sentinels)
    h1, h2, h3, h4 = draws(F.col(doc_id), seed)
    whole = F.coalesce(F.col(text), F.lit(""))
    cut = F.pandas_udf(find, ", ".join(f"{c} long" for c in CUT))(whole.cast("binary"), h1, h2)
    marked = F.contains(whole, p) | F.contains(whole, s) | F.contains(whole, m)
    plain = (F.length(whole) == 0) | marked | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    kept = docs.drop(*ADDED).columns
    # The document's own columns travel in a struct, out of the way of the names used here.
    rows = docs.select(F.struct(*[f"`{c}`" for c in kept]).alias("doc"), whole.cast("binary").alias("raw"), form.alias("form"), cut.alias("cut"))

    def part(begin: Column, length: Column) -> Column:
        return F.substring("raw", begin.cast("int") + 1, length.cast("int")).cast("string")

    a, b = F.col("cut.prefix_bytes"), F.col("cut.middle_bytes")
    prefix, middle, suffix = part(F.lit(0), a), part(a, b), part(a + b, F.octet_length("raw"))
    psm, spm = F.concat(p, prefix, s, suffix, m, middle), F.concat(s, suffix, p, prefix, m, middle)
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("raw").cast("string"))
    chars = [F.when(F.col("form") != "plain", F.col(f"cut.{c}")).alias(c) for c in ("prefix_chars", "middle_chars")]
    return rows.select(*[F.col(f"doc.`{c}`") for c in kept], F.col("cut.n").alias("n"), "form", *chars, output.alias("output"))


def restore(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text an output was made from. No text with a sentinel is cut, so each sentinel stands once."""
    parts = F.split(output, "|".join(rf"\Q{x}\E" for x in sentinels), -1)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)
