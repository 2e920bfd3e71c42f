"""Personal data: fixed patterns, and a character tagger for what they miss.

The tagger is trained in numpy on spans the patterns label, some of them rewritten as people write them. Text is read in
overlapping windows; the windows' scores are averaged where they overlap, and one path is decoded over the whole stretch.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import packed, stored, text_of
from prepkit.llm.tagger import Tagger, encode

KINDS = ("email", "ip", "card", "phone")
#: Windows learned from at most; passes over them; characters to a window, from one to the next, and of context.
SAMPLE, EPOCHS, WINDOW, STRIDE, CONTEXT = 1500, 12, 64, 40, 20
#: Least mean probability of a span that the tagger adds, and how often a span is rewritten where it may be.
SURE, REWRITTEN = 0.6, 0.8

_TRIGGER = re.compile(r"[0-9@]")
_RUN = re.compile(r"\S+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"([0-9]++(?:\.[0-9]++){3})|[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Groups of digits joined by a few signs or a spelt dot, and how far from a span its groups are looked for.
_GROUPED = re.compile(r"[0-9]++(?:(?:[ ._/()\[\]-]{1,4}+| dot )[0-9]++)*+")
GROUPS = 48


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(int(c) * 2 - 9 * (c > "4") for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def _ip_ok(text: str) -> bool:
    parts = re.findall(r"[0-9]+", text)
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in parts)


def _card_ok(text: str) -> bool:
    digits = "".join(_DIGIT.findall(text))
    return 16 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(text: str) -> bool:
    return 8 <= len(_DIGIT.findall(text)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind, then start.

    Each pattern is matched leftmost and without overlap in a form that takes a run of characters at once, so that
    long runs cost no more than their length: a match cannot begin inside a run if it does not at its head.
    """
    out = []
    if "@" in text:
        done, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            m = _DOMAIN.match(text, at + 1) if start < at else None
            if m:
                out.append((0, start, m.end()))
                done = m.end()
            else:
                done = at + 1
            at = text.find("@", max(done, at + 1))
    if not _DIGIT.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if m[1] and _ip_ok(m[1])]
    out += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 16 and _card_ok(m[0])]
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if _phone_ok(m[0])]
    return out


def _tags(length: int, spans) -> np.ndarray:
    """0 outside, 2k + 1 where a span of kind k begins, 2k + 2 inside it."""
    out = np.zeros(length, np.int64)
    for kind, a, b in spans:
        out[max(a, 0):b] = 2 * kind + 2
        if 0 <= a < length:
            out[a] = 2 * kind + 1
    return out


def rewritten(text: str, spans, rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with some spans as people also write them: phones without +, other separators in cards and addresses."""
    out, at, moved, size = [], 0, [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        piece = text[a:b]
        if rng.random() < REWRITTEN:
            if kind == 3:
                piece = re.sub(r"[ ().-]+", rng.choice([" ", "-", "."]), piece.removeprefix("+"))
            elif kind == 2:
                digits = re.sub("[^0-9]", "", piece)
                piece = rng.choice([".", "/", "_"]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
            elif kind == 1:
                piece = piece.replace(".", rng.choice([" . ", "[.]", " dot "]))
            elif kind == 0:
                piece = piece.replace("@", rng.choice([" @ ", "@ "]), 1)
        out += [text[at:a], piece]
        size += a - at
        moved.append((kind, size, size + len(piece)))
        size += len(piece)
        at = b
    return "".join([*out, text[at:]]), moved


def stretches(text: str, spans) -> list[tuple[int, int]]:
    """Parts of the text in which the tagger could add a span: context around marks outside the patterns' spans.

    A span it may add has an @, or four digits or more, and overlaps none of the patterns' spans. Spans of numbers begin
    and end at their marks; around an @ a part takes in the whole runs of non-blanks on both sides, at most ``CONTEXT``
    blanks away and up to the next of the patterns' spans, so that long local parts and domains are not cut. Parts do
    not overlap.
    """
    taken = sorted((a, b) for _, a, b in spans)
    marks, k = [], 0
    for m in _TRIGGER.finditer(text):
        p = m.start()
        while k < len(taken) and taken[k][1] <= p:
            k += 1
        if not (k < len(taken) and taken[k][0] <= p):
            marks.append(p)
    runs = [m.span() for m in _RUN.finditer(text)] if any(text[p] == "@" for p in marks) else []
    starts, heads, ends = [a for a, _ in runs], [a for a, _ in taken], sorted(b for _, b in taken)
    out, i = [], 0
    while i < len(marks):
        j = i
        while j + 1 < len(marks) and marks[j + 1] - marks[j] <= CONTEXT:
            j += 1
        held = [text[p] for p in marks[i:j + 1]]
        if "@" in held or len(held) >= 4:
            lo, hi = marks[i], marks[j] + 1
            for p in (p for p in marks[i:j + 1] if text[p] == "@"):
                a, z = _around(runs, bisect_right(starts, p) - 1, p)
                before, after = bisect_right(ends, p), bisect_right(heads, p)
                a, z = max([a, *ends[before - 1:before]]), min([z, *heads[after:after + 1]])
                lo, hi = min(lo, a), max(hi, z)
            lo, hi = max(0, lo - CONTEXT), min(len(text), hi + CONTEXT)
            while out and lo < out[-1][1]:
                a, z = out.pop()
                lo, hi = min(lo, a), max(hi, z)
            out.append((lo, hi))
        i = j + 1
    return out


def _around(runs: list[tuple[int, int]], k: int, p: int) -> tuple[int, int]:
    """From where the non-blanks before the @ at ``p`` begin to where those after it end; ``p`` lies in run ``k``."""
    a, z = runs[k]
    if a == p and k and a - runs[k - 1][1] <= CONTEXT:
        a = runs[k - 1][0]
    if z == p + 1 and k + 1 < len(runs) and runs[k + 1][0] - z <= CONTEXT:
        z = runs[k + 1][1]
    return a, z


def _windows(a: int, b: int) -> list[tuple[int, int]]:
    """Overlapping windows over a stretch."""
    out, at = [], a
    while True:
        out.append((at, min(b, at + WINDOW)))
        if at + WINDOW >= b:
            return out
        at += STRIDE


def _lessons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(order, text, tags): windows around the marks of each text, as they are and rewritten."""
    for b in batches:
        orders, texts, tags = [], [], []
        for text in b.column("text").to_pylist():
            rng = random.Random(hashlib.md5(text.encode("utf-8", "replace")).digest())
            spans = base_spans(text)
            for now, named in ((text, spans), rewritten(text, spans, rng)):
                marks = [m.start() for m in _TRIGGER.finditer(now)]
                at = -1
                for p in marks:
                    if p <= at:
                        continue
                    lo = max(0, p - rng.randrange(CONTEXT // 2, CONTEXT))
                    piece = now[lo:lo + WINDOW]
                    at = lo + WINDOW - 1
                    label = _tags(len(piece), [(k, s - lo, e - lo) for k, s, e in named if s < lo + WINDOW and e > lo])
                    texts.append(piece)
                    tags.append(label.tolist())
                    orders.append(hashlib.md5(piece.encode("utf-8", "replace")).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(orders, pa.string()), pa.array(texts, pa.string()), pa.array(tags, pa.list_(pa.int64()))], ["order", "text", "tags"])


def learn(docs: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS, text_col: str = "text") -> Tagger | None:
    """A tagger from windows of the texts, labelled by the patterns: half of them hold a span, if there are enough.

    The ``sample`` windows of the smallest hashes are chosen from all texts, so reruns agree. None if no text has a mark.
    """
    texts = docs.select(text_of(text_col).alias("text")).where(F.col("text").rlike("[0-9@]"))
    made = texts.mapInArrow(_lessons, "order string, text string, tags array<long>")
    made = made.withColumn("spanned", F.exists("tags", lambda t: t > 0))
    counted = made.groupBy("spanned").agg(F.approx_count_distinct("order").alias("n")).collect()
    low = F.lit(False)
    for r in counted:
        low = low | ((F.col("spanned") == r["spanned"]) & (F.col("order") < _share(r["n"], sample // 2)))
    made = stored(made.where(low).dropDuplicates(["order"]), "pii-windows")
    rows = []
    for side in (True, False):
        rows += made.where(F.col("spanned") == side).orderBy("order").limit(sample // 2).collect()
    if not rows:
        return None
    codes = np.array([encode(r["text"], WINDOW) for r in rows])
    tags = np.zeros((len(rows), WINDOW), np.int64)
    for k, r in enumerate(rows):
        tags[k, :len(r["tags"])] = r["tags"]
    tagger = Tagger(2 * len(KINDS) + 1)
    tagger.train(codes, tags, epochs)
    return tagger


def _share(n: int, wanted: int) -> str:
    """A bound that about four times ``wanted`` of ``n`` window hashes pass, at least 400, to keep the sort small."""
    part = min(1.0, 4.0 * max(wanted, 100) / max(1, n))
    return "g" if part >= 1 else f"{int(part * 16**8):08x}"


def _decoded(tagger: Tagger, jobs: list[tuple[int, str, int]], size: int = 512) -> list[tuple[int, int, int, int, float]]:
    """(job's row, kind, start, end, probability) for each span the tagger sees in the jobs (row, stretch, its start)."""
    pieces = [(j, a, b) for j, (_, text, _) in enumerate(jobs) for a, b in _windows(0, len(text))]
    sums = [np.zeros((len(text), tagger.tags), np.float32) for _, text, _ in jobs]
    weights = [np.zeros((len(text), 1), np.float32) for _, text, _ in jobs]
    slope = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]
    for lo in range(0, len(pieces), size):
        part = pieces[lo:lo + size]
        em, _ = tagger.emissions(np.array([encode(jobs[j][1][a:b], WINDOW) for j, a, b in part]))
        for (j, a, b), e in zip(part, em):
            sums[j][a:b] += e[: b - a] * slope[: b - a]
            weights[j][a:b] += slope[: b - a]
    out = []
    order = sorted(range(len(jobs)), key=lambda j: len(jobs[j][1]))
    while order:
        longest = len(jobs[order[-1]][1])
        n = max(1, min(len(order), size * WINDOW // longest))
        group, order = order[-n:], order[:-n]
        lengths = np.array([len(jobs[j][1]) for j in group])
        em = np.zeros((len(group), longest, tagger.tags), np.float32)
        for k, j in enumerate(group):
            em[k, : lengths[k]] = sums[j] / weights[j]
        paths = tagger.best(em, lengths)
        _, sure, _ = tagger.marginals(em, lengths)
        for k, j in enumerate(group):
            row, _, start = jobs[j]
            path = paths[k, : lengths[k]]
            for head in np.flatnonzero(path % 2 == 1).tolist():
                kind, end = (path[head] - 1) // 2, head + 1
                while end < len(path) and path[end] == 2 * kind + 2:
                    end += 1
                mean = float(sure[k, np.arange(head, end), path[head:end]].mean())
                out.append((row, int(kind), start + head, start + end, mean))
    return out


def _fits(kind: int, text: str) -> bool:
    """What a span the tagger adds must hold, whatever separates it."""
    if kind == 0:
        return "@" in text and "." in text.partition("@")[2]
    if kind == 1:
        return _ip_ok(text)
    return _card_ok(text) if kind == 2 else 10 <= len(_DIGIT.findall(text)) <= 15


def _snapped(kind: int, text: str, a: int, z: int, lo: int, hi: int) -> tuple[int, int]:
    """A span with the rest of what it cuts, within ``lo`` and ``hi``, and without what cannot begin or end it.

    An address takes in the runs of non-blanks it begins and ends in, but no signs at their ends. A number takes in its
    whole digits, and if that holds what its kind needs, all groups of digits that short separators join to it.
    """
    while a < z and text[a].isspace():
        a += 1
    while z > a and text[z - 1].isspace():
        z -= 1
    if kind == 0:
        while a > lo and not text[a - 1].isspace():
            a -= 1
        while z < hi and not text[z].isspace():
            z += 1
        while z > a and not text[z - 1].isalnum():
            z -= 1
        while a < z and text[a] not in _LOCAL:
            a += 1
        return a, z
    while a < z and text[a] not in "0123456789(+":
        a += 1
    while z > a and text[z - 1] not in "0123456789":
        z -= 1
    while lo < a < z and text[a] in "0123456789" and text[a - 1] in "0123456789":
        a -= 1
    while a < z < hi and text[z] in "0123456789":
        z += 1
    if a < z and not _fits(kind, text[a:z]):
        from_, to = max(lo, a - GROUPS), min(hi, z + GROUPS)
        for m in _GROUPED.finditer(text, from_, to):
            if m.start() < z and m.end() > a and _fits(kind, m[0]):
                return m.span()
    return a, z


def _spans_of(tagger: Tagger | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            more: list[list] = [[] for _ in texts]
            if tagger:
                jobs = [(i, t[a:z], a) for i, t in enumerate(texts) for a, z in stretches(t, base[i])]
                for i, kind, a, z, sure in _decoded(tagger, jobs):
                    lo = max((e for _, s, e in base[i] if s < a), default=0)
                    hi = min((s for _, s, e in base[i] if e > z), default=len(texts[i]))
                    a, z = _snapped(kind, texts[i], a, z, lo, hi)
                    if sure >= SURE and _fits(kind, texts[i][a:z]) and all(z <= s or e <= a for _, s, e in base[i]):
                        more[i].append((kind, a, z))
            lists = [[{"kind": k, "start": s, "stop": e, "base": f} for k, s, e, f in sorted(
                [(*x, True) for x in mine] + [(*x, False) for x in extra])] for mine, extra in zip(base, more)]
            kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(lists, kind)], ["row", "found"])

    return run


def find(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, found): each row of ``docs`` with its spans (kind, start, stop, base), by kind, then start.

    ``kind`` is a place in ``KINDS``; places count code points, ends are exclusive; ``base`` marks what the patterns found.
    Null and empty texts have none. No other column is read; all are carried along in ``row``.
    """
    rows = packed(docs, id_col, text_col).select("row", "text")
    kind = "array<struct<kind:int,start:int,stop:int,base:boolean>>"
    return rows.mapInArrow(_spans_of(tagger), "row " + rows.schema["row"].dataType.simpleString() + f", found {kind}")


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")


def digests(docs: DataFrame) -> DataFrame:
    """Counts and digest of the patterns' spans, and all spans, for each document."""
    found = find(docs.select("doc_id", "text"), learn(docs))
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s.kind], s.start.cast("string"), s["stop"].cast("string"))), ",")

    base = F.filter("found", lambda s: s.base)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[_count(base, k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))
