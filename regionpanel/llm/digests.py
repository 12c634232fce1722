"""Digests of ordered rows: texts run through the hash row by row, so no group is held in memory.

Rows of one key are sorted (spilling if need be) in one task and read as a stream of Arrow batches; what is kept between
batches is the state of the hashes. SHA-256 runs over a whole group in order, so a group is one task's work in any case.

Defined results: null pieces add nothing; rows with a null key are a group of their own; no rows give no digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


def ordered_digests(rows: DataFrame, key: str, order: Sequence[str], pieces: Mapping[str, Column]) -> DataFrame:
    """Per ``key`` the number of rows (``n_rows``), and for every piece, joined in ``order``, ``<name>_sha256`` and the
    code points ``<name>_chars``. ``order`` must be unique within a key."""
    names = list(pieces)
    out = [T.StructField(key, rows.schema[key].dataType), T.StructField("n_rows", T.LongType())]
    for name in names:
        out += [T.StructField(f"{name}_sha256", T.StringType()), T.StructField(f"{name}_chars", T.LongType())]
    columns = [f.name for f in out]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_, count, done, kind = None, False, 0, [], None
        hashes, chars = [], []

        def close() -> None:
            done.append((at, count, *[x for h, c in zip(hashes, chars, strict=True) for x in (h.hexdigest(), c)]))

        def flush() -> pa.RecordBatch:
            values = list(zip(*done, strict=True))
            done.clear()
            types = [kind, pa.int64(), *[t for _ in names for t in (pa.string(), pa.int64())]]
            return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(values, types, strict=True)], names=columns)

        for batch in batches:
            kind = batch.column(0).type
            for k, *texts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not open_ or k != at:
                    if open_:
                        close()
                    at, open_, count = k, True, 0
                    hashes, chars = [hashlib.sha256() for _ in names], [0] * len(names)
                count += 1
                for i, text in enumerate(texts):
                    if text is not None:
                        hashes[i].update(text.encode("utf-8"))
                        chars[i] += len(text)
            if done:
                yield flush()
        if open_:
            close()
            yield flush()

    sorted_ = rows.select(key, *order, *[p.alias(f"_{n}") for n, p in pieces.items()]).repartition(key).sortWithinPartitions(key, *order)
    return sorted_.select(key, *[f"_{n}" for n in names]).mapInArrow(digest, T.StructType(out))
