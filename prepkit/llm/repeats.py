"""Suffix-array deduplication of byte strings across documents, in shards of bounded size.

Equal strings of ``length`` bytes must meet in one shard. Each such window is keyed by the least hash of the shorter
strings in it, so equal windows have equal keys; neighbouring windows mostly share theirs and travel as one segment.
Keys that occur once are dropped by two Bloom filters and equal segments are folded before any bytes are shuffled.
What remains meets by key in shards, and a shard's repeats come from its Burrows-Wheeler transform.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.bwt import repeat_groups
from prepkit.llm.shared import bounded, stored, sweep
from prepkit.llm.shingles import U, bytes_of, mixed, pieces, powers
from prepkit.llm.twice import Repeats, passing

LENGTH, GRAM = 100, 32
#: Windows to a segment at most, bytes to a shard, segments of a key beyond which its windows are dealt out singly.
SEGMENT_WINDOWS, SHARD_BYTES, KEY_SEGMENTS = 512, 1 << 18, 4096
#: Texts held as Python objects at once, and bytes worked on at once.
AT_ONCE, PIECE = 500, 1 << 17

_BASE, _BASE2 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)


def _inverse(odd: np.uint64) -> np.uint64:
    x = 1
    for _ in range(6):
        x = x * (2 - int(odd) * x) % (1 << 64)
    return U(x)


def rolling(data: np.ndarray, length: int, base: np.uint64 = _BASE) -> np.ndarray:
    """A hash of each ``length`` bytes: differences of prefix sums, moved back by the inverse power of their place.

    Its high bits are well mixed, its low ones are not.
    """
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, U)
    terms = (data.astype(np.uint16) + np.uint16(1)) * powers(base, len(data))
    sums = np.cumsum(terms)
    out = sums[length - 1:].copy()
    out[1:] -= sums[: n - 1]
    out *= powers(_inverse(base), n)
    return out


def over(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least (or what ``pick`` picks) of each ``width`` neighbours, by doubling."""
    span, out = 1, values
    while span * 2 <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    return pick(out[: len(out) - (width - span)], out[width - span:]) if width > span else out


def _self_repeating(hashes: np.ndarray, least: np.ndarray, whole: np.ndarray, width: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which runs of windows, from ``begin`` to ``end``, may hold two equal windows: longer than ``width``, or over two
    neighbouring places of one hash that is the least of some window. Too many are named, never too few."""
    edge = np.zeros(width - 1, U)
    reach = over(np.concatenate([edge, np.where(whole, least, U(0)), edge]), width, np.maximum)
    at = np.flatnonzero(reach[: len(hashes)] == hashes)
    twin = np.flatnonzero((hashes[at[1:]] == hashes[at[:-1]]) & (np.diff(at) < width))
    first, second = at[twin], np.append(at[twin + 1], len(hashes) + width)
    return (end - begin > width) | (second[np.searchsorted(first, begin)] < end + width - 1)


def segments_of(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(key, text, first window, windows, whether it may repeat itself) of each segment: runs of windows of one text with
    the same key."""
    gram = min(GRAM, length)
    width = length - gram + 1
    n = len(data) - length + 1
    none = np.zeros(0, U), *[np.zeros(0, np.int64)] * 3, np.zeros(0, bool)
    if n <= 0:
        return none
    hashes = rolling(data, gram)
    least = over(hashes, width)
    owner = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    whole = owner[:n] == owner[length - 1:]
    head = whole.copy()
    head[1:] &= ~whole[:-1] | (least[1:] != least[:-1])
    at = np.flatnonzero(head)
    if not len(at):
        return none
    lasts = np.append(at[1:], n)
    upto = np.concatenate([[0], np.cumsum(whole)])
    size = upto[lasts] - upto[at]
    again = _self_repeating(hashes, least, whole, width, at, at + size)
    parts = -(-size // SEGMENT_WINDOWS)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(at, parts) + nth * SEGMENT_WINDOWS
    size = np.minimum(np.repeat(size, parts) - nth * SEGMENT_WINDOWS, SEGMENT_WINDOWS)
    text = owner[first]
    return mixed(least[first] ^ _BASE2), text, first - starts[:-1][text], size, np.repeat(again, parts)


def _keys(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, starts = bytes_of(b.column("text"))
            for lo, hi in pieces(starts, PIECE):
                key, *_, again = segments_of(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo], length)
                key = np.concatenate([key, key[again]])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])

    return run


def _segments(length: int, shared, segments: int):
    """(key, same, first, tie, start, windows, again, bytes) of the segments whose key may occur twice."""
    names = ["key", "same", "first", "tie", "start", "windows", "again", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, starts = bytes_of(b.column("text"))
            for lo, hi in pieces(starts, PIECE):
                found = segments_of(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo], length)
                if shared is not None:
                    keep = passing(shared.value, segments, found[0])
                    found = tuple(x[keep] for x in found)
                key, text, at, size, again = found
                begin = starts[lo:hi][text] + at
                held = [data[p:p + n + length - 1].tobytes() for p, n in zip(begin.tolist(), size.tolist())]
                same = [hashlib.blake2b(x, digest_size=16).digest() for x in held]
                row = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(same, pa.binary()), b.column("first").take(row), b.column("tie").take(row),
                     pa.array(at), pa.array(size), pa.array(again), pa.array(held, pa.binary())], names)

    return run


def _marks(rows: list[dict], length: int) -> tuple[list, list, list, list]:
    """One shard: (first, tie, start, stop) of the stretches of its segments that also start earlier."""
    rows.sort(key=lambda r: (r["first"], r["tie"], r["start"]))
    sizes = np.array([len(r["bytes"]) for r in rows])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.zeros(starts[-1], np.int64)
    for r, a in zip(rows, starts.tolist()):
        text[a:a + len(r["bytes"])] = np.frombuffer(r["bytes"], np.uint8).astype(np.int64) + 1
    order, group = repeat_groups(text, length)
    owner = np.repeat(np.arange(len(rows)), sizes + 1)
    whole = (np.arange(len(text)) - starts[owner] <= sizes[owner] - length)[order]
    order, group = order[whole], group[whole]
    earliest = np.full(int(group.max()) + 1 if len(group) else 0, len(text))
    np.minimum.at(earliest, group, order)  # segments lie by document, so an earlier place here is one there
    later = np.sort(order[order != earliest[group]])
    if not len(later):
        return [], [], [], []
    cut = np.flatnonzero((np.diff(later) != 1) | (owner[later[1:]] != owner[later[:-1]])) + 1
    heads, tails = later[np.concatenate([[0], cut])], later[np.concatenate([cut, [len(later)]]) - 1]
    own = owner[heads].tolist()
    begin = [rows[k]["start"] + int(h - starts[k]) for k, h in zip(own, heads)]
    stop = [a + int(t - h) + length for a, h, t in zip(begin, heads, tails)]
    return [rows[k]["first"] for k in own], [rows[k]["tie"] for k in own], begin, stop


def _shards(length: int):
    """Rows sorted by shard and key, one run to a shard; keys of a single segment that cannot repeat itself are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _marks(rows, length)], ["first", "tie", "start", "stop"])

        held, same, at = [], [], None
        for b in batches:
            for r in b.to_pylist():
                now = (r["shard"], r["key"])
                if now != at:
                    if len(same) > 1 or same and same[0]["again"]:
                        held += same
                    same = []
                    if at and now[0] != at[0] and held:
                        yield emit(held)
                        held = []
                at = now
                same.append(r)
        if len(same) > 1 or same and same[0]["again"]:
            held += same
        if held:
            yield emit(held)

    return run


def _window_hashes(length: int):
    """(one, two, first, tie, start) of every window of each segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, starts = bytes_of(b.column("bytes"))
            for lo, hi in pieces(starts, PIECE):
                mine, begin = data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo]
                owner = np.repeat(np.arange(hi - lo), np.diff(begin))
                n = max(0, len(mine) - length + 1)
                at = np.flatnonzero(owner[:n] == owner[length - 1:length - 1 + n])
                row = pa.array(owner[at] + lo)
                first = b.column("start").to_numpy()[lo:hi][owner[at]] + at - begin[owner[at]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mixed(rolling(mine, length, x)[at]).view(np.int64)) for x in (_BASE, _BASE2)]
                    + [b.column("first").take(row), b.column("tie").take(row), pa.array(first)], ["one", "two", "first", "tie", "start"])

    return run


def _cut(batches: Iterator[pa.RecordBatch], hand_on: bool) -> Iterator[pa.RecordBatch]:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) of each text without its marked stretches."""
    for whole in batches:
        for at in range(0, whole.num_rows, AT_ONCE):
            b = whole.slice(at, AT_ONCE)
            sizes, gone, spans, sha, left = [], [], [], [], []
            for text, marks, copy in zip(*(b.column(c).to_pylist() for c in ("text", "marks", "copy"))):
                raw = (text or "").encode()
                runs: list[list[int]] = []
                marks = [{"start": 0, "stop": len(raw)}] if copy else marks
                for m in sorted(marks or (), key=lambda m: m["start"]):
                    if runs and m["start"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], m["stop"])
                    else:
                        runs.append([m["start"], m["stop"]])
                kept, done = [], 0
                for a, z in runs:
                    kept.append(raw[done:a])
                    done = z
                out = b"".join([*kept, raw[done:]])
                sizes.append(len(raw))
                gone.append(len(raw) - len(out))
                spans.append(len(runs))
                sha.append(hashlib.sha256(out).hexdigest())
                left.append(out if hand_on else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(left, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_spans(texts: DataFrame, length: int = LENGTH, key_segments: int = KEY_SEGMENTS, shard_bytes: int = SHARD_BYTES,
                   filter_bytes: int | None = None) -> DataFrame:
    """(first, tie, start, stop): stretches of the texts (first, tie, text) whose every window of ``length`` bytes also
    starts earlier, in order of (first, tie, start). Stretches may overlap. Texts must differ from each other."""
    n = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    how = {} if filter_bytes is None else {"most_bytes": filter_bytes}
    twice = Repeats(texts.select("text").mapInArrow(_keys(length), "key long"), 1 + 2 * n // (length - min(GRAM, length) + 1), **how)
    shared = twice.shared()
    schema = "key long, same binary, first long, tie long, start long, windows long, again boolean, bytes binary"
    found = texts.mapInArrow(_segments(length, shared, twice.segments), schema)
    if shared is None:
        found = twice.suspected(found, "key")
    found = stored(found, "repeat-segments")
    sweep(texts.sparkSession)
    place = F.struct("first", "tie", "start")
    distinct = stored(found.groupBy("key", "same").agg(
        F.min(place).alias("lead"), F.first("bytes").alias("bytes"), F.max("again").alias("again"), F.count(F.lit(1)).alias("n"),
    ), "repeat-distinct")
    sweep(texts.sparkSession)

    leads = distinct.where("n > 1").select("key", "same", "lead")
    folded = found.select("key", "same", "first", "tie", "start", "windows").join(leads, ["key", "same"]).where(place != F.col("lead"))
    folded = folded.select("first", "tie", "start", (F.col("start") + F.col("windows") + (length - 1)).alias("stop"))

    sizes = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("segments"), F.sum(F.octet_length("bytes")).alias("size"), F.max("again").alias("again")).where("segments > 1 OR again")
    sizes = stored(sizes, "repeat-keys")
    total = sizes.where(F.col("segments") <= key_segments).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    hot = bounded(sizes.where(F.col("segments") > key_segments).select(F.col("key").alias("hot")))
    few = distinct.join(hot, F.col("key") == F.col("hot"), "left_anti")
    few = few.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(shards)))
    dealt = few.select("shard", "key", "again", "lead.first", "lead.tie", "lead.start", "bytes")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "key")
    marked = dealt.mapInArrow(_shards(length), "first long, tie long, start long, stop long")

    many = distinct.join(hot, F.col("key") == F.col("hot")).select("lead.first", "lead.tie", "lead.start", "bytes")
    windows = many.mapInArrow(_window_hashes(length), "one long, two long, first long, tie long, start long")
    heads = windows.groupBy("one", "two").agg(F.min(place).alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    single = windows.join(heads, ["one", "two"]).where(place != F.col("lead"))
    single = single.select("first", "tie", "start", (F.col("start") + length).alias("stop"))
    return folded.unionByName(marked).unionByName(single)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hand_on: bool = True,
                   **how) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row of ``docs``; ``kept`` only if ``hand_on``.

    Texts are taken as UTF-8 bytes, null as empty. A byte goes if it lies in a ``length``-byte string that also starts
    earlier: in a document of a smaller id, or earlier in the same one; all is judged on the input. ``kept`` holds the
    bytes left, in which a character may be cut. A null id comes after all others. Rows that share an id and their text
    are one document and treated alike; different texts under one id are ordered by their hash. Texts shorter than
    ``length`` stay whole. Other columns are not read.
    """
    last = (1 << 63) - 1
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("at", F.coalesce(F.col("id").cast("long"), F.lit(last))).withColumn("tie", F.xxhash64("text"))
    rows = rows.withColumn("tie2", F.xxhash64(F.lit(1), "text"))
    copied = rows.where(F.octet_length("text") >= length).groupBy("tie", "tie2").agg(F.min("at").alias("first"), F.max("at").alias("top"))
    copied = stored(copied.where("first < top").select(F.col("tie").alias("c1"), F.col("tie2").alias("c2"), "first"), "repeat-copies")
    same = (F.col("tie") == F.col("c1")) & (F.col("tie2") == F.col("c2"))
    rows = rows.join(bounded(copied), same, "left").withColumn("copy", F.coalesce(F.col("at") > F.col("first"), F.lit(False)))
    alone = rows.where((~F.col("copy")) & (F.octet_length("text") >= length))
    spans = repeated_spans(alone.select(F.col("at").alias("first"), "tie", "text"), length, **how)
    marks = spans.groupBy(F.col("first").alias("m1"), F.col("tie").alias("m2")).agg(F.collect_list(F.struct("start", "stop")).alias("marks"))
    marks = stored(marks, "repeat-marks")
    del spans
    sweep(docs.sparkSession)
    joined = rows.join(marks, (F.col("at") == F.col("m1")) & (F.col("tie") == F.col("m2")), "left").select("id", "text", "marks", "copy")
    kind = joined.schema["id"].dataType.simpleString()
    return joined.mapInArrow(partial(_cut, hand_on=hand_on), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """Sizes and digest of what is left of each document."""
    return remove_repeats(docs, hand_on=False).select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
