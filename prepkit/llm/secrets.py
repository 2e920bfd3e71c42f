"""Secret scans behind a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived: every match must hold them. Postings of those
trigrams are kept by document, intersected there, and only the documents that remain are searched with the pattern
itself. A pattern that demands no trigram searches all documents. Case plays no part in the index, so it can only let
through too much, never too little.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as kinds
from re import _parser as patterns

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import text_of

#: Most strings a part of a pattern may stand for before it is cut off there, and largest class spelt out.
MOST_STRINGS, MOST_CHARS = 64, 6


@dataclass(frozen=True)
class Rule:
    """``kind`` of secret; ``pattern`` found leftmost, non-overlapping; a match whose ``group`` is under ``least`` long is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The asked kinds. A run of hex digits is as long as it can be, so asking for 32 of them finds the same runs.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Published token formats that the asked kinds leave out.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + MORE

#: All of: one of: all of these trigrams.
Query = tuple[tuple[frozenset[str], ...], ...]


def _strings(item) -> list[str] | None:
    """Every string a part of a pattern can stand for, if they are few."""
    op, arg = item
    if op is kinds.LITERAL:
        return [chr(arg)]
    if op is kinds.IN:
        chars = []
        for what, x in arg:
            if what is kinds.LITERAL:
                chars.append(chr(x))
            elif what is kinds.RANGE and x[1] - x[0] < MOST_CHARS:
                chars += map(chr, range(x[0], x[1] + 1))
            else:
                return None
        return chars if len(chars) <= MOST_CHARS else None
    if op is kinds.SUBPATTERN:
        return _sequence(arg[-1])
    if op is kinds.BRANCH:
        found = [_sequence(x) for x in arg[1]]
        return None if any(x is None for x in found) else [s for x in found for s in x]
    if op is kinds.MAX_REPEAT and arg[1] is not kinds.MAXREPEAT and arg[1] <= 5:
        once = _sequence(arg[2])
        if once is None:
            return None
        out, power = ([""] if arg[0] == 0 else []), [""]
        for n in range(1, arg[1] + 1):
            power = [a + b for a in power for b in once]
            if len(power) > MOST_STRINGS:
                return None
            out += power if n >= arg[0] else []
        return out
    return None


def _sequence(items) -> list[str] | None:
    out = [""]
    for item in items:
        found = _strings(item)
        if found is None or len(out) * len(found) > MOST_STRINGS:
            return None
        out = [a + b for a in out for b in found]
    return out


def _clause(strings: list[str]) -> tuple[frozenset[str], ...]:
    sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in (x.lower() for x in strings)}
    return tuple(sorted((x for x in sets if not any(y < x for y in sets)), key=sorted))


def trigram_query(pattern: str) -> Query:
    """The trigrams any match of ``pattern`` must hold, lower-cased; empty if it demands none."""
    clauses: list[tuple[frozenset[str], ...]] = []

    def walk(items) -> None:
        run = [""]
        for item in items:
            found = _strings(item)
            if found is not None and len(run) * len(found) <= MOST_STRINGS:
                run = [a + b for a in run for b in found]
                continue
            clauses.append(_clause(run))
            run = found if found is not None else [""]
            op, arg = item
            if found is None and op is kinds.SUBPATTERN:
                walk(arg[-1])
            elif found is None and op is kinds.MAX_REPEAT and arg[0] > 0:
                walk(arg[2])
        clauses.append(_clause(run))

    walk(patterns.parse(pattern))
    return tuple(dict.fromkeys(c for c in clauses if all(c)))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """``docs`` (with ``text``) with ``grams``, those of the trigrams that each row holds, in either case.

    The index is kept by row, beside the text, so that looking up a row's postings moves nothing.
    """
    lowered = docs.withColumn("low", F.lower("text"))  # by itself, so that it is done once and not for each trigram
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in trigrams]))
    return lowered.withColumn("grams", held).drop("low")


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """``index`` with ``kinds`` for ``grams``: the rules whose trigram query the row's postings satisfy."""
    def holds(query: Query) -> Column:
        every = F.lit(True)
        for clause in query:
            some = F.lit(False)
            for grams in clause:
                both = F.lit(True)
                for g in sorted(grams):
                    both = both & F.array_contains("grams", g)
                some = some | both
            every = every & some
        return every

    kinds_held = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]))
    return index.withColumn("kinds", kinds_held).drop("grams")


def _spans(rule: Rule, rank: int) -> Column:
    """array of (start, rank, stop, kind) in code points: matches lie between the pieces that splitting by them leaves."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda s: F.char_length(s) >= rule.least)
    sizes = F.zip_with(
        F.transform(F.split(text, rule.pattern, -1), F.char_length), F.transform(found, F.char_length),
        lambda gap, size: F.struct(gap.alias("gap"), size.alias("size")),
    )
    made = F.aggregate(
        F.zip_with(sizes, kept, lambda s, k: F.struct(s.gap.alias("gap"), s.size.alias("size"), k.alias("keep"))),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>").alias("out")),
        lambda acc, s: F.struct(
            (acc.at + s.gap + F.coalesce(s["size"], F.lit(0))).alias("at"),
            F.when(
                F.coalesce(s.keep, F.lit(False)),
                F.concat(acc.out, F.array(F.struct(
                    (acc.at + s.gap).alias("start"), F.lit(rank).alias("rank"),
                    (acc.at + s.gap + s["size"]).alias("stop"), F.lit(rule.kind).alias("kind"),
                ))),
            ).otherwise(acc.out).alias("out"),
        ),
    )
    return made.out


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s["stop"].cast("string"))), ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): every row of ``docs`` with its spans, an array of (start, rank, stop, kind), by start, then rank.

    ``rank`` is the rule's place in ``rules``; ends are exclusive; positions count code points. Null and empty texts have
    no spans. Every row is looked up and searched by itself, whatever its id, in one pass over the texts without a
    shuffle. Other columns are not read.
    """
    for rule in rules:
        re.compile(rule.pattern)
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    grams = sorted({g for q in queries.values() for clause in q for alternative in clause for g in alternative})
    rows = candidates(postings(rows, grams), queries)
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")
    parts = []
    for rank, rule in enumerate(rules):
        if rule.kind in queries:
            here = F.array_contains("kinds", rule.kind)
        else:
            here = F.col("text").rlike(rule.pattern)
        parts.append(F.when(here, _spans(rule, rank)).otherwise(none))
    return rows.select(F.col("id").alias("doc_id"), F.array_sort(F.flatten(F.array(*parts))).alias("found"))


def _count(rank: int) -> Column:
    return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long")


def scan_digests(docs: DataFrame) -> DataFrame:
    """The counts and digests of the asked kinds, and all spans, for each document."""
    found = scan(docs)
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    return found.select(
        "doc_id",
        *[_count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )
