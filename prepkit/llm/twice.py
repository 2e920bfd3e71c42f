"""Which hashes occur twice or more, found with two Bloom filters and without shuffling what was hashed.

Map tasks hand on, for each segment of the hash space, their hashes, each at most twice. A segment's task runs them
through a filter of hashes seen once; those that were in it already go into a filter of hashes seen twice. A hash that
occurs twice is always found; a few that occur once are, too, so callers confirm what passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import stored

U = np.uint64
#: Hashes to a segment, bits of filter for a hash, probes, hashes a map task holds, bytes of filters for a broadcast.
SEGMENT_HASHES, BITS, PROBES, HELD, MOST_BYTES = 1 << 19, 12, 6, 1 << 20, 64 << 20


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(U)


def _probes(h: np.ndarray, size) -> Iterator[np.ndarray]:
    """Bit places of each hash in a filter of ``size`` bits (a number, or one for each hash)."""
    a, b = h >> U(32), (h & U(0xFFFFFFFF)) | U(1)
    for k in range(PROBES):
        yield ((a + U(k) * b) % size).astype(np.int64)


def _blobs(segments: int):
    def emit(parts: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(parts), return_counts=True)
        h = np.concatenate([h, h[n > 1]])
        seg = (h % U(segments)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        h, seg = h[order], seg[order]
        cuts = np.flatnonzero(np.diff(seg)) + 1
        heads = seg[np.concatenate([[0], cuts])] if len(seg) else seg
        return pa.RecordBatch.from_arrays(
            [pa.array(heads), pa.array([x.tobytes() for x in np.split(h, cuts)] if len(seg) else [], pa.binary())], ["segment", "hashes"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            if b.num_rows:
                parts.append(_unsigned(b.column(0)))
                held += b.num_rows
            if held >= HELD:
                yield emit(parts)
                parts, held = [], 0
        if held:
            yield emit(parts)

    return run


def _filters(group: pd.DataFrame) -> pd.DataFrame:
    """One segment: its hashes through the filter of those seen once; the ones met again make the second filter."""
    size = U(max(64, BITS * sum(len(x) // 8 for x in group["hashes"])))
    once = np.zeros(int(size), bool)
    met = []
    for blob in group["hashes"]:
        h = np.frombuffer(blob, U)
        u, n = np.unique(h, return_counts=True)
        seen = np.ones(len(u), bool)
        for at in _probes(u, size):
            seen &= once[at]
        met.append(u[seen | (n > 1)])
        for at in _probes(u, size):
            once[at] = True
    again = np.unique(np.concatenate(met))
    if not len(again):
        return pd.DataFrame({"segment": [], "size": [], "bits": [], "again": []})
    size = U(max(64, BITS * len(again)))
    twice = np.zeros(int(size), bool)
    for at in _probes(again, size):
        twice[at] = True
    return pd.DataFrame({
        "segment": group["segment"].iloc[:1].to_numpy(), "size": [int(size)], "bits": [np.packbits(twice).tobytes()],
        "again": [again.view(np.int64)],
    })


def passing(filters, segments: int, h: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filters (sizes, starts, bits) let through."""
    size, start, bits = filters
    seg = (h % U(segments)).astype(np.int64)
    where = np.flatnonzero(size[seg] > 0)
    h, seg = h[where], seg[where]
    keep = np.ones(len(h), bool)
    for at in _probes(h, size[seg].astype(U)):
        place = start[seg] + at
        keep &= (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
    return where[keep]


def _passing(shared, segments: int, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.take(pa.array(passing(shared.value, segments, _unsigned(b.column(column)))))

    return run


class Repeats:
    """The filters of hashes that occur at least twice in ``hashes``: one column of longs, well mixed, none null."""

    def __init__(self, hashes: DataFrame, rows: int, segment_hashes: int = SEGMENT_HASHES, most_bytes: int = MOST_BYTES):
        self.segments = max(1, -(-rows // segment_hashes))
        self.spark = hashes.sparkSession
        blobs = hashes.mapInArrow(_blobs(self.segments), "segment long, hashes binary")
        made = blobs.groupBy("segment").applyInPandas(_filters, "segment long, size long, bits binary, again array<long>")
        self.table = stored(made, "twice")
        self.bytes = self.table.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
        self.most_bytes = most_bytes

    def shared(self):
        """The filters (sizes, starts, bits) broadcast to all tasks, or None if they are too large for that."""
        if self.bytes > self.most_bytes:
            return None
        size, start, parts, at = np.zeros(self.segments, np.int64), np.zeros(self.segments, np.int64), [], 0
        for r in self.table.select("segment", "size", "bits").collect():
            size[r["segment"]], start[r["segment"]] = r["size"], at
            parts.append(np.frombuffer(r["bits"], np.uint8))
            at += 8 * len(parts[-1])
        bits = np.concatenate(parts) if parts else np.zeros(1, np.uint8)
        return self.spark.sparkContext.broadcast((size, start, bits))

    def suspected(self, df: DataFrame, column: str) -> DataFrame:
        """The rows whose hash may occur twice.

        The filters are broadcast while they are small; beyond that, the hashes they were made of are joined.
        """
        shared = self.shared()
        if shared is None:
            listed = self.table.select(F.explode("again").alias("again"))
            return df.join(listed, df[column] == listed["again"], "left_semi")
        return df.mapInArrow(_passing(shared, self.segments, df.columns.index(column)), df.schema)
