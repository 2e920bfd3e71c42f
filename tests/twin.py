"""Runs a registered query and its SQL twin on the same files and compares the results.

Usage: python -m tests.twin [--sf 0.01] [--sql-only] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from datetime import datetime
from decimal import Decimal

import duckdb

from prepkit.queries import REGISTRY
from prepkit.session import build_session

DATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    return v


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(cell(r[i]) for i in order) for r in rows), key=lambda r: [(v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r]
    )


def kind(name: str) -> str:
    name = name.lower()
    for family, members in {
        "double": ("double", "float"), "bigint": ("bigint", "long", "hugeint"), "int": ("int", "integer"),
        "string": ("string", "varchar"), "bool": ("boolean",), "decimal": ("decimal",),
    }.items():
        if name.split("(")[0] in members:
            return family + ("!" if name == "hugeint" else "")
    return name


def compare(spark, con, name: str, folder: str) -> list[str]:
    """Differences between the query and its twin; empty when they agree."""
    entry = REGISTRY[name]
    df = entry.run(spark, folder)
    got_names, got = table_of(df.columns, df.collect())
    if entry.sql is None:
        return [] if got else ["no rows"]
    found = con.execute(entry.sql)
    types = {d[0]: str(d[1]) for d in found.description}
    want_names, want = table_of([d[0] for d in found.description], found.fetchall())
    out = []
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    for f in df.schema.fields:
        if kind(f.dataType.simpleString()) != kind(types[f.name]):
            out.append(f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}")
    if len(got) != len(want):
        return [*out, f"rows {len(got)} != {len(want)}"]
    exact = close = 0
    for g, w in zip(got, want):
        if g == w:
            continue
        near = all(a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)) for a, b in zip(g, w))
        close += near
        exact += not near
        if exact + close <= 3:
            out.append(f"row {g} != {w}")
    if exact or close:
        out.append(f"{exact} rows differ, {close} only nearly equal")
    if any(str(v) == "-0.0" for r in got for v in r):
        out.append("negative zero")
    return out


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--sql-only", action="store_true")
    args = parser.parse_args()
    folder = f"{DATA}/sf{args.sf}"
    names = args.names or [n for n, e in REGISTRY.items() if e.sql or not args.sql_only]
    con = oracle(folder)
    if args.sql_only:
        for n in names:
            try:
                con.execute(REGISTRY[n].sql).fetchall()
            except Exception as e:
                print("SQL", n, str(e)[:300])
        return 0
    spark = build_session("twin", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for n in names:
        start = time.time()
        try:
            found = compare(spark, con, n, folder)
        except Exception as e:
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'BAD' if found else 'ok '} {n} {time.time() - start:.2f}s", *found, sep="\n      " if found else " ", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
