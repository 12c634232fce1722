"""Conversation structure repair: edit the turns of a conversation into an optional system turn and user-assistant pairs.

Faults are found by windows over a conversation's turns. Its turns, one letter each, are then aligned (Wagner-Fischer)
to every target of the grammar ``(s?(ua)+)?`` that can be the cheapest. All targets end alike, so one matrix, filled from
the end, holds the costs of all of them; a second layer adds a leading system turn. A quick repair of the turns from left
to right gives the incumbent cost, and only the band of cells from which a total within it is possible is filled (Ukkonen).
The audits of the cheapest targets are traced back and the least of them in ASCII order is taken.

Memory of an alignment is the band times about two square roots of the turns: rows of the matrix are kept at intervals
and filled again block by block for the backtrace. Work on a conversation is ordered, so one task sorts its turns
(spilling) and one aligns its letters; the repaired turns are joined to their texts by conversation and place, which
spreads a long conversation over tasks.

Defined results: null roles and texts are one space; turns come by number, nulls first, equal numbers by role and text;
rows alike in all of these are duplicates of the first; very long texts are only looked at by Spark; conversations of null
id are one conversation; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Costs of the edits; keeping is free, and keeping or changing a truncated turn costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 40
ROLE = {"u": "user", "a": "assistant"}
#: Letter of a turn that has to go; other letters are the role's initial, in upper case for truncated turns.
GONE = "x"

EDITS = "cost long, audit string, edits array<struct<at: long, position: long, role: string>>"
EDIT_LIST = pa.list_(pa.struct([("at", pa.int64()), ("position", pa.int64()), ("role", pa.string())]))


def damage(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults put in by the checksum of conversation and turn, for tests of the repair.

    Of twenty values 0 drops the row, 1 empties its text, 2 takes its ends of sentences out, 3 repeats it, 4 makes it a
    user's. Nulls read as one space; ids and turns stay null.
    """

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    hit = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"), kind.alias("_kind"))
    return hit.filter("_kind <> 0").withColumn("_copy", copies).drop("_kind", "_copy")


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with ``position`` (from 1), ``fault``, ``letter`` for the alignment,
    ``new_turn`` and ``illegal`` (the step from the turn before is none the grammar has).

    Partitioned by conversation once; every window and grouping by conversation after it stays in place.
    """
    own = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = rows.select("conv_id", "turn", *own).repartition("conv_id")
    seen = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("_seen", F.row_number().over(seen))
    along = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "_seen")
    initial = F.substring("role", 1, 1)
    step = F.concat(F.lag(initial).over(along), initial)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = F.col("text").rlike(r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z")
    fault = F.when(blank, "blank").when(F.col("_seen") > 1, "duplicate").when(cut, "truncated")
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    rows = rows.select(
        "conv_id", "turn", "role", "text", "_seen",
        F.row_number().over(along).cast("long").alias("position"),
        fault.alias("fault"), letter.alias("letter"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(along))).alias("new_turn"),
        F.coalesce(~step.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
    )
    coded = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper("letter")).otherwise(F.col("letter"))
    return rows.withColumn("letter", coded).drop("_seen")


def audits(found: DataFrame) -> DataFrame:
    """One row per conversation of `faults`: counts of its faults, ``cost``, ``audit`` and the ``edits``.

    ``edits`` has the place in the repaired conversation, the position of the turn it comes from (null: inserted) and
    the new role (null: its own). ``gaps`` is null where it does not fit a long.
    """
    span = F.try_subtract(F.max("turn"), F.min("turn"))
    gaps = F.when(F.max("turn").isNull(), 0).otherwise(F.try_add(span, 1 - F.count_if("new_turn")))
    letters = F.array_sort(F.collect_list(F.struct("position", "letter")))
    out = found.groupBy("conv_id").agg(
        gaps.cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == kind).alias(kind) for kind in ("blank", "duplicate", "truncated")],
        F.count_if("illegal").alias("illegal"),
        F.array_join(F.transform(letters, lambda x: x["letter"]), "").alias("_letters"),
    )
    return out.mapInArrow(_aligned, T.StructType([*out.drop("_letters").schema.fields, *T.StructType.fromDDL(EDITS).fields]))


def repaired(found: DataFrame, audit: DataFrame) -> DataFrame:
    """The turns after repair: ``conv_id``, ``at`` (from 0), ``role``, ``text``; inserted turns have empty texts."""
    edits = audit.select("conv_id", F.explode("edits").alias("e")).select("conv_id", "e.*").withColumnRenamed("role", "new_role")
    turns = found.select(F.col("conv_id").alias("_conv"), F.col("position").alias("_from"), "role", "text")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("position") == F.col("_from"))
    joined = edits.join(turns, same, "left")
    return joined.select("conv_id", "at", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with cost, audit and edits in place of the letters, their last column."""
    for batch in batches:
        codes = batch.column(batch.num_columns - 1)
        done = {code: Alignment(code).best() for code in codes.unique().to_pylist()}
        costs, audits = zip(*(done[code] for code in codes.to_pylist()), strict=True) if len(codes) else ((), ())
        edits = [[dict(zip(("at", "position", "role"), e, strict=True)) for e in edits_of(audit)] for audit in audits]
        added = [pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(edits, EDIT_LIST)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=[*batch.schema.names[:-1], "cost", "audit", "edits"])


def symbol(left: int) -> str:
    """First symbol of what is left of a target of user-assistant pairs."""
    return "a" if left % 2 else "u"


def edits_of(audit: str) -> list[tuple[int, int | None, str | None]]:
    """Place, source and new role of every turn that an audit leaves. The length of the result says what it begins with."""
    out, position = [], 0
    length = len(audit) - audit.count("D")
    for edit in audit:
        position += edit != "I"
        if edit != "D":
            role = None if edit == "K" else ROLE[symbol(length - len(out))]
            out.append((len(out), None if edit == "I" else position, role))
    return out


def quick_cost(letters: str) -> int:
    """Cost of a repair from left to right: a user or assistant turn out of order gets the missing one put before it, any
    other gets the expected role, a missing answer is added at the end; or of deleting all turns, if that is cheaper."""
    fixed = DELETE * letters.count(GONE)
    turns = [x for x in letters if x != GONE]
    fixed += TRUNCATED * sum(x.isupper() for x in turns)
    turns = [x.lower() for x in turns]
    most = DELETE * len(letters)
    for begin in {0, int(turns[:1] == ["s"])}:
        cost, expected = fixed, "u"
        for x in turns[begin:]:
            if x != expected and x in ROLE:
                cost += INSERT
            else:
                cost += REROLE * (x != expected)
                expected = "a" if expected == "u" else "u"
        cost += INSERT * (expected == "a") + 2 * INSERT * (begin == len(turns) > 0)
        most = min(most, cost)
    return most


class Alignment:
    """Costs of aligning the turns from i on with the last m symbols of the targets, in bands around the diagonal.

    A row of the matrix is ``(low, pairs, led)``: from column ``low`` on the costs for the alternating symbols alone, and
    those for a system turn before them.
    """

    def __init__(self, letters: str):
        self.letters, self.n = letters, len(letters)
        free = np.array([x != GONE for x in letters], dtype=np.int64)
        cut = np.array([x.isupper() for x in letters], dtype=np.int64)
        fixed = DELETE * int((1 - free).sum()) + TRUNCATED * int(cut.sum())
        self.spare = quick_cost(letters) - fixed
        #: Free and truncated turns from i on.
        self.free = np.r_[np.cumsum(free[::-1])[::-1], 0]
        self.cut = np.r_[np.cumsum(cut[::-1])[::-1], 0]
        self.every = max(isqrt(self.n), 16)

    def band(self, i: int) -> tuple[int, int]:
        """Columns of row i from which a total within the incumbent is possible; a leading system turn takes one more.

        Every symbol beyond the free turns is an insert, every free turn beyond the symbols a deletion, which is only
        1 dearer than keeping for a truncated turn.
        """
        cheap = DELETE - TRUNCATED
        cut = int(self.cut[i])
        gone = self.spare // cheap if self.spare <= cut * cheap else cut + (self.spare - cut * cheap) // DELETE
        return max(int(self.free[i]) - gone - 1, 0), int(self.free[i]) + self.spare // INSERT

    def last(self) -> tuple[int, np.ndarray, np.ndarray]:
        low, high = self.band(self.n)
        return low, INSERT * np.arange(low, high + 1, dtype=np.int64), np.full(high - low + 1, FAR, dtype=np.int64)

    def row(self, i: int, below: tuple[int, np.ndarray, np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
        """Row i from the row of i + 1."""
        low, high = self.band(i)
        columns = np.arange(low, high + 1, dtype=np.int64)
        x, extra = self.letters[i].lower(), TRUNCATED * self.letters[i].isupper()
        stay, led = (_moved(below[0], part, low, high) for part in below[1:])
        pairs, lead = stay + DELETE, led + DELETE
        if x != GONE:
            match = (columns % 2 == 1) if x == "a" else (columns % 2 == 0) if x == "u" else np.zeros(len(columns), dtype=bool)
            used = _moved(below[0], below[1], low - 1, high - 1) + np.where(match, 0, REROLE) + extra
            pairs = np.minimum(pairs, np.where(columns > 0, used, FAR))
            if x == "s":
                lead = np.minimum(lead, np.where((columns > 0) & (columns % 2 == 0), stay + extra, FAR))
        pairs = np.minimum.accumulate(pairs - INSERT * columns) + INSERT * columns
        return low, np.minimum(pairs, FAR), np.minimum(lead, FAR)

    def best(self) -> tuple[int, str]:
        """The least cost, and of the audits with it the least one."""
        kept = {self.n: self.last()}
        at = kept[self.n]
        for i in range(self.n - 1, -1, -1):
            at = self.row(i, at)
            if i % self.every == 0:
                kept[i] = at
        low, pairs, led = at
        even = (low + np.arange(len(pairs))) % 2 == 0
        totals = np.where(even, np.minimum(pairs, led), FAR)
        cost = int(totals.min())
        targets = [(low + int(m), lead) for lead, part in ((False, pairs), (True, led)) for m in np.flatnonzero(even & (part == cost))]
        return cost, min(self._audits(kept, targets))

    def _audits(self, kept: dict[int, tuple], targets: list[tuple[int, bool]]) -> Iterator[str]:
        """Audits of the targets that can be the least, traced block by block; one that is already behind is dropped."""
        states = [(m, lead, "") for m, lead in targets]
        for begin, end in pairwise([*range(0, self.n, self.every), self.n]):
            rows = {end: kept[end]}
            for i in range(end - 1, begin - 1, -1):
                rows[i] = self.row(i, rows[i + 1])
            states = [self._through(rows, begin, end, *state) for state in states]
            least = min(audit for *_, audit in states)
            states = [s for s in states if s[2] == least or least.startswith(s[2]) or s[2].startswith(least)]
        for m, _, audit in states:
            yield audit + "I" * m

    def _through(self, rows: dict[int, tuple], begin: int, end: int, m: int, lead: bool, audit: str) -> tuple[int, bool, str]:
        """The least edits of the turns from ``begin`` to ``end`` on a cheapest way, with ``m`` symbols left."""
        out, i = [], begin
        while i < end:
            extra = TRUNCATED * self.letters[i].isupper()
            if lead:
                # Only deleting or keeping leads to a system turn.
                lead = _cell(rows[i + 1], 2, m) + DELETE == _cell(rows[i], 2, m)
                out.append("D" if lead else "K")
                i += 1
                continue
            cost = _cell(rows[i], 1, m)
            if _cell(rows[i + 1], 1, m) + DELETE == cost:
                out.append("D")
            elif m and _cell(rows[i], 1, m - 1) + INSERT == cost:
                out.append("I")
                m -= 1
                continue
            else:
                fits = self.letters[i].lower() == symbol(m)
                assert _cell(rows[i + 1], 1, m - 1) + extra + REROLE * (not fits) == cost
                out.append("K" if fits else "R")
                m -= 1
            i += 1
        return m, lead, audit + "".join(out)


def _moved(low: int, part: np.ndarray, begin: int, end: int) -> np.ndarray:
    """``part``, whose first column is ``low``, for the columns ``begin`` to ``end``."""
    out = np.full(end - begin + 1, FAR, dtype=np.int64)
    a, b = max(low, begin), min(low + len(part) - 1, end)
    if a <= b:
        out[a - begin : b - begin + 1] = part[a - low : b - low + 1]
    return out


def _cell(row: tuple[int, np.ndarray, np.ndarray], layer: int, column: int) -> int:
    at = column - row[0]
    return int(row[layer][at]) if 0 <= at < len(row[layer]) else FAR
