import hashlib
from collections import defaultdict

import pytest

from prepkit.llm import line_dedup

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, min_chars, keep):
    where = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            where[line.strip(BLANKS).translate(LOWER)].add(i)
    out = []
    for i, t, *_ in rows:
        lines, stay, seen = (t or "").split("\n"), [], set()
        for line in lines:
            key = line.strip(BLANKS).translate(LOWER)
            common = len(key) >= min_chars and len(where[key]) >= min_docs
            first = keep == "first" and key not in seen and i == min(where[key], key=lambda x: (x is None, x or 0))
            if not common or first:
                stay.append(line)
            seen.add(key)
        text = "\n".join(stay)
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **how):
    found = line_dedup.line_dedup(df, **how)
    return sorted(((r.row.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in found.collect()), key=str)


@pytest.fixture(scope="module")
def lined():
    rows = []
    for i in range(40):
        lines = [f"own line {i}", " Licence \t", "", f"pair {i // 2}", "ÄRGER" if i % 3 else "ärger"]
        if i % 4 == 0:
            lines += ["LICENCE", "\x0bonce in four\r"]
        rows.append((i, "\n".join(lines), "en", "a"))
    return rows


@pytest.mark.parametrize("how", [{}, {"min_docs": 2}, {"min_docs": 3, "keep": "first"}, {"min_docs": 2, "min_chars": 8}, {"most_bytes": 0}])
def test_equals_brute_force(docs, lined, how):
    want = {k: how.get(k, d) for k, d in (("min_docs", 10), ("min_chars", 1), ("keep", "none"))}
    assert got(docs(lined), **how) == brute(lined, **want)


def test_odd_rows(odd, odd_rows, empty):
    rows = [(i, t) for i, t, *_ in odd_rows]
    assert got(odd, min_docs=2) == brute(rows, 2, 1, "none")
    assert got(empty) == []


def test_columns_are_kept_and_characters_counted_anew(docs, lined, odd):
    out = line_dedup.cleaned(docs(lined))
    assert out.columns == docs(lined).columns
    assert all(r.n_chars == len(r.text) and r.row == 1 and r.kept == "k" for r in out.collect())
    assert line_dedup.cleaned(odd).where("text IS NULL").count() == 2
