import random

import pytest
from pyspark.sql import functions as F

from prepkit.operators import lookup, places, ranges
from prepkit.sources import readers


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_numbers_are_consecutive_in_order(spark):
    df = spark.range(5000, numPartitions=7).select(F.pmod(F.col("id") * 7919, F.lit(5000)).alias("k"), F.col("id").alias("x"))
    got = places.numbered(df, "k").collect()
    assert all(r.place == r.k for r in got) and len(got) == 5000
    assert places.numbered(df.limit(0), "k").collect() == []


def test_ties_are_spread_and_numbered_once(spark):
    df = spark.range(3000, numPartitions=3).select(F.when(F.col("id") % 3 > 0, 1).alias("k"), F.lit("same").alias("s"))
    got = places.numbered(df, "k", "at")
    assert sorted(r["at"] for r in got.collect()) == list(range(3000))
    assert {r.k for r in got.where("at < 1000").collect()} == {None}  # missing first
    assert got.collect() == got.collect()


@pytest.mark.parametrize("files", [1, 3])
def test_first_rows_of_files_in_many_splits(spark, tmp_path, small_splits, files):
    for f in range(files):
        lines = "".join(f"{f * 5000 + i},{'x' * (i % 40)}\n" for i in range(5000))
        (tmp_path / f"part{f}.csv").write_text("k,v\n" + lines)
    for n in (0, 899, 5000, 5001, 10**6):
        df = readers.read_csv(spark, str(tmp_path), schema="k int, v string", max_rows=n)
        assert sorted(r.k for r in df.collect()) == list(range(min(n, 5000 * files))) and df.columns == ["k", "v"]
    assert sorted(r._c0 for r in readers.read_csv(spark, str(tmp_path / "part0.csv"), header=False, infer=False, max_rows=3).collect()) == ["0", "1", "k"]


def test_places_of_an_ingested_folder(spark, tmp_path, small_splits):
    for f, name in enumerate(("b.csv", "a.csv")):
        (tmp_path / name).write_text("k\n" + "".join(f"{(1 - f) * 2000 + i}\n" for i in range(2000)))
    (tmp_path / "c.json").write_text("\n".join('{"k": %d}' % (4000 + i) for i in range(900)))
    whole = readers.ingest_folder(spark, str(tmp_path), "k int")
    assert whole.rdd.getNumPartitions() > 3
    assert all(r.k == r.place for r in places.read_places(whole).collect())


def test_side_by_side_of_unequal_tables(spark):
    left = spark.createDataFrame([(i, f"l{i}") for i in (3, 1, 2)], "k int, s string")
    right = spark.createDataFrame([(float(i), f"r{i}") for i in range(5)], "z double, s string")
    got = {r.place: (r.k, r.s, r.z, r.s_right) for r in places.side_by_side(left, right, "k", ["z"], suffix="_right").collect()}
    assert got == {0: (1, "l1", 0.0, "r0"), 1: (2, "l2", 1.0, "r1"), 2: (3, "l3", 2.0, "r2"), 3: (None, None, 3.0, "r3"), 4: (None, None, 4.0, "r4")}
    assert places.side_by_side(left, right, "k", "z").columns == ["place", "k", "s", "z"]
    assert places.side_by_side(left.limit(0), right.limit(0), "k", "z").collect() == []


def test_rows_without_a_key_add_up(spark):
    left = spark.createDataFrame([(None, i) for i in range(300)] + [(1, 0)], "k int, a int")
    right = spark.createDataFrame([(None, i) for i in range(300)] + [(1, 5), (2, 6)], "k int, b int")
    got = lookup.align_by_key(left, right, "k")
    assert got.count() == 602 and got.where("k = 1").select("a", "b").collect() == [(0, 5)]
    assert got.where("k IS NULL AND a IS NOT NULL AND b IS NOT NULL").count() == 0


def brute(values, spans, closed):
    out = []
    for i, v in values:
        for j, lo, hi in spans:
            if v is None or v != v:
                continue
            above = lo is None or (v >= lo if closed in ("both", "left") else v > lo)
            below = hi is None or (v <= hi if closed in ("both", "right") else v < hi)
            # ends the wrong way round hold nothing by either test
            if above and below:
                out.append((i, j))
    return sorted(out)


def made(seed):
    rng = random.Random(seed)
    values = [(i, rng.choice([rng.uniform(-50, 50), float(rng.randint(-5, 5)), rng.choice([1e12, -1e-9, 0.0])])) for i in range(150)]
    values += [(150, None), (151, float("nan")), (152, 2.0**53), (153, float("-0.0"))]
    spans = []
    for j in range(120):
        lo = rng.choice([rng.uniform(-60, 60), float(rng.randint(-6, 6))])
        spans.append((j, rng.choice([lo, lo, None]), rng.choice([lo, lo + 10 ** rng.uniform(-6, 3), lo + rng.randint(0, 4), None, lo - 1])))
    spans += [(120, None, None), (121, 1e12, 1e12), (122, -1e300, 1e300), (123, 0.0, 0.0)]
    return values, spans


@pytest.mark.parametrize("closed", ["both", "left", "right", "neither"])
def test_ranges_equal_every_test(spark, closed):
    values, spans = made(4)
    df = spark.createDataFrame(values, "i int, v double")
    table = spark.createDataFrame(spans, "j int, lo double, hi double")
    met = ranges.range_join(df, "v", table, "lo", "hi", closed=closed, broadcast_rows=0 if closed == "left" else ranges.BROADCAST_RANGES)
    want = brute(values, spans, closed)
    assert sorted((r.i, r.j) for r in met.collect()) == want
    left = ranges.range_join(df, "v", table, "lo", "hi", "left", closed)
    alone = {i for i, _ in values} - {i for i, _ in want}
    assert sorted((r.i, r.j) for r in left.where("j IS NOT NULL").collect()) == want
    assert {r.i for r in left.where("j IS NULL").collect()} == alone


@pytest.mark.parametrize("closed", ["both", "left", "right", "neither"])
def test_totals_of_ranges_equal_the_pairs(spark, closed):
    values, spans = made(5)
    df = spark.createDataFrame(values + values[:20], "i int, v double")
    table = spark.createDataFrame(spans + spans[:9] + [(124, float("nan"), None), (125, None, float("nan"))], "j int, lo double, hi double")
    pairs = ranges.range_join(df, "v", table, "lo", "hi", closed=closed)
    want = pairs.groupBy("j").agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    met = ranges.range_join(df, "v", table, "lo", "hi", "totals", closed)
    assert met.columns == ["j", "lo", "hi", "n", "least", "most"]
    got = met.groupBy("j").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_totals_of_mixed_types_and_empty_tables(spark):
    days = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2020-01-31')) AS d")
    terms = spark.sql("SELECT 'a' AS term, timestamp'2020-01-05 12:00:00' AS lo, timestamp'2020-01-09 00:00:00' AS hi")
    got = ranges.range_join(days, "d", terms, "lo", "hi", "totals").first()
    assert (got.n, got.least.day, got.most.day) == (4, 6, 9)
    large = spark.createDataFrame([(2**53,), (2**53 + 1,)], "v long")
    spans = spark.createDataFrame([(2**53 + 1, 2**53 + 1)], "lo long, hi long")
    assert tuple(ranges.range_join(large, "v", spans, "lo", "hi", "totals").first())[2:] == (1, 2**53 + 1, 2**53 + 1)
    assert ranges.range_join(days.limit(0), "d", terms, "lo", "hi", "totals").collect() == []
    assert ranges.range_join(days, "d", terms.limit(0), "lo", "hi", "totals").collect() == []
    with pytest.raises(TypeError):
        ranges.range_join(terms, "term", terms, "lo", "hi", "totals")


@pytest.mark.parametrize("closed", ["both", "left", "right", "neither"])
def test_lookup_in_ranges_equals_every_test(spark, closed):
    values, spans = made(6)
    # two columns to find, the first shared by ranges and missing in some
    spans = [(j, lo, hi) for j, lo, hi in spans if lo is not None or hi is not None] + [(130, float("nan"), None), (131, None, float("nan"))]
    spans = [s for s in spans if s[0] % 3 or s[0] > 125]
    df = spark.createDataFrame(values + values[:20], "i int, v double")
    table = spark.createDataFrame([(None if j == 7 else j % 4, -j, lo, hi) for j, lo, hi in spans], "name int, k int, lo double, hi double")
    pairs = ranges.range_join(df.distinct(), "v", table, "lo", "hi", closed=closed)
    best = {r.i: tuple(r.b) for r in pairs.groupBy("i").agg(F.min(F.struct("name", "k")).alias("b")).collect()}
    got = ranges.range_lookup(df, "v", table, "lo", "hi", ["name", "k"], closed)
    assert got.columns == ["i", "v", "name", "k"] and len(best) > 100
    assert sorted((r.i, (r.name, r.k)) for r in got.collect()) == sorted(((i, best.get(i, (None, None))) for i, _ in values + values[:20]), key=lambda t: t[0])


def test_lookup_meets_one_piece_a_row(spark):
    df = spark.range(1000).select("id", (F.col("id") % 50 + 0.5).alias("v"))
    table = spark.range(200).select((-F.col("id")).alias("lo"), (F.col("id") + 60).alias("hi"), F.concat(F.lit("r"), F.col("id")).alias("name"))
    got = ranges.range_lookup(df, "v", table, "lo", "hi", ["name"], "left")
    # neither grouped by row nor joined with itself
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Join") == 1
    assert {r.name for r in got.collect()} == {"r0"} and got.count() == 1000
    for cut in (table.limit(0), table.select(F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"), "name")):
        assert {r.name for r in ranges.range_lookup(df, "v", cut, "lo", "hi", ["name"]).collect()} == ({None} if cut.count() == 0 else {"r0"})


def test_range_columns_dates_and_empty_tables(spark):
    days = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2020-01-31')) AS d")
    terms = spark.sql("SELECT 'a' AS term, date'2020-01-05' AS lo, date'2020-01-09' AS hi UNION ALL SELECT 'b', date'2020-01-09', null")
    got = ranges.range_lookup(days, "d", terms, "lo", "hi", ["term"])
    assert got.columns == ["d", "term"]
    assert sorted((r.d.day, r.term) for r in got.collect()) == [(k, "a" if 5 <= k <= 9 else "b" if k > 9 else None) for k in range(1, 32)]
    assert ranges.range_join(days.limit(0), "d", terms, "lo", "hi").collect() == []
    assert ranges.range_join(days, "d", terms.limit(0), "lo", "hi", "left").count() == 31
    with pytest.raises(TypeError):
        ranges.range_join(terms, "term", terms, "lo", "hi")
    with pytest.raises(ValueError):
        ranges.range_join(days, "d", terms, "lo", "hi", how="outer")


def test_many_ranges_share_a_cell_plan_without_a_cross_join(spark):
    df = spark.range(20000).select((F.col("id") % 1000).cast("double").alias("v"))
    table = spark.range(100_000).select((F.col("id") / 100).alias("lo"), (F.col("id") / 100 + F.col("id") % 3).alias("hi"))
    met = ranges.range_join(df, "v", table, "lo", "hi")
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert met.count() == 20 * spark.sql("SELECT v FROM (SELECT explode(sequence(0, 999)) AS v)").crossJoin(
        table.groupBy("lo", "hi").agg(F.count("*").alias("n"))).where("v BETWEEN lo AND hi").agg(F.sum("n")).first()[0]
