"""Second look at texts, knowing which of their features occur elsewhere.

Many operators only care for features (hashes) that a text shares with others. Chunks of texts send their distinct
features, sorted and packed, to hash ranges; each range sends back those that occur more than once; and the chunk's
texts, compressed, meet the answer. A feature that most texts have is one entry per chunk, so no range grows with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame

from .common import bounded
from .shingles import BITS, pack, unpack

#: Bytes of text of a chunk; what a task holds in memory follows from it.
CHUNK_BYTES = 1_500_000

Features = Callable[[list[bytes]], np.ndarray]
Made = Callable[[pd.Series, np.ndarray, list[bytes], np.ndarray], pd.DataFrame]

BACK = "chunk long, features binary, ids binary, hashes binary, sizes binary, texts binary"
NAMES = ["chunk", "features", "ids", "hashes", "sizes", "texts"]


def packed_ids(ids: pd.Series) -> bytes:
    """Which ids are known, then all ids with 0 for null, as int64."""
    ids = ids.astype("Int64")
    return np.r_[ids.notna().to_numpy().astype(np.int64), ids.fillna(0).astype("int64").to_numpy()].tobytes()


def chunks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[tuple[int, pd.DataFrame, list[bytes]]]:
    """Identity, rows and texts as UTF-8 of consecutive rows; rows alike give chunks alike, wherever they are read."""
    for batch in batches:
        raw = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in batch["text"]]
        for a, b in bounded(map(len, raw), size):
            part = batch.iloc[a:b]
            chunk = xxhash.xxh3_64(b"\0".join(raw[a:b]))
            chunk.update(part["text_hash"].to_numpy().tobytes())
            chunk.update(packed_ids(part["doc_id"]))
            yield chunk.intdigest() >> 1, part, raw[a:b]


def ranges_of(values: np.ndarray, ranges: int) -> np.ndarray:
    """Where each hash range begins in sorted features."""
    edges = (np.arange(ranges + 1, dtype=object) * (1 << BITS) // ranges).astype(np.uint64)
    return np.searchsorted(values, edges)


def repeated_features(texts: DataFrame, features: Features, ranges: int, size: int) -> DataFrame:
    """For every chunk and range the features that occur more than once, packed."""

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk, _, raw in chunks(batches, size):
            values, counts = np.unique(features(raw), return_counts=True)
            cut = ranges_of(values, ranges)
            rows = [(i, chunk, pack(values[x:y]), pack(counts[x:y] > 1)) for i, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if y > x]
            yield pd.DataFrame(rows, columns=["range", "chunk", "features", "more"])

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("chunk")
        mine = [unpack(x) for x in rows["features"]]
        more = np.concatenate([unpack(x) for x in rows["more"]]).astype(np.int64)
        every, place = np.unique(np.concatenate(mine), return_inverse=True)
        total = np.bincount(place, weights=1 + more, minlength=len(every))
        out, at = [], 0
        for chunk, values in zip(rows["chunk"], mine, strict=True):
            hit = values[total[place[at : at + len(values)]] > 1]
            at += len(values)
            if len(hit):
                out.append((chunk, pack(hit), None, None, None, None))
        return pd.DataFrame(out, columns=NAMES)

    parts = texts.mapInPandas(sent, "range int, chunk long, features binary, more binary")
    return parts.groupBy("range").applyInPandas(counted, BACK)


def second_look(texts: DataFrame, features: Features, made: Made, schema: str, ranges: int, size: int = CHUNK_BYTES) -> DataFrame:
    """Rows that ``made`` gives for every chunk from ids, text hashes, texts and the sorted repeated features.

    ``texts`` has ``doc_id`` (long), ``text_hash`` and ``text``; ``features`` gives numbers below 2 ** ``BITS``, as
    often as they occur. ``size`` is the bytes of text of a chunk. Rows alike in id and text meet once.
    """

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk, part, raw in chunks(batches, size):
            sizes = np.array([len(r) for r in raw], dtype=np.int64)
            packed = zstandard.ZstdCompressor(level=3).compress(b"".join(raw))
            row = (chunk, None, packed_ids(part["doc_id"]), part["text_hash"].to_numpy().astype("int64").tobytes(), sizes.tobytes(), packed)
            yield pd.DataFrame([row], columns=NAMES)

    def look(rows: pd.DataFrame) -> pd.DataFrame:
        head, hits = rows[rows["texts"].notna()].iloc[0], rows[rows["features"].notna()]
        if not len(hits):
            return pd.DataFrame([])
        at = np.r_[0, np.cumsum(np.frombuffer(head["sizes"], dtype=np.int64))]
        data = zstandard.ZstdDecompressor().decompress(head["texts"])
        raw = [data[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
        known, ids = np.frombuffer(head["ids"], dtype=np.int64).reshape(2, -1)
        ids = pd.Series(ids, dtype="Int64").mask(known == 0)
        found = np.sort(np.concatenate([unpack(x) for x in hits["features"]]))
        return made(ids, np.frombuffer(head["hashes"], dtype=np.int64), raw, found)

    rows = texts.mapInPandas(headers, BACK).unionByName(repeated_features(texts, features, ranges, size))
    return rows.groupBy("chunk").applyInPandas(look, schema)


def among(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``found``."""
    if not len(found):
        return np.zeros(len(values), dtype=bool)
    return found[np.minimum(np.searchsorted(found, values), len(found) - 1)] == values
