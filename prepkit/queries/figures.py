"""Figures of many columns, of merged parts, and of all groups at once."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators import gram, profile, shapes, sketches
from prepkit.queries.registry import query, rounded, table
from prepkit.sources.frozen import frozen

MANY = 24
CELLS = {f"c{k}": f"CASE WHEN (l_orderkey + l_linenumber) % {k + 5} <> 0 THEN l_quantity * {k % 4} + l_extendedprice / {k + 1} + "
                  f"(l_partkey % {2 * k + 3}) * {k * 10 + 1} END" for k in range(MANY)}
PAIRS_SQL = ", ".join(
    f"{{'col_a': '{a}', 'col_b': '{b}', 'r': round(corr({a}, {b}), 6), 'n': count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL)}}"
    for a, b in combinations(CELLS, 2)
)


@query(f"""
WITH made AS (SELECT {', '.join(f'({x})::double AS {c}' for c, x in CELLS.items())} FROM lineitem)
SELECT unnest([{PAIRS_SQL}], recursive := true) FROM made
""")
def corr_many_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Every two of many columns, each with gaps of its own."""
    made = table(spark, folder, "lineitem").select(*[F.expr(x).cast("double").alias(c) for c, x in CELLS.items()])
    return rounded(gram.gram_correlations(made, list(CELLS)), 6, "r")


@query("""
SELECT c AS "column", count(*) AS n, count(*) FILTER (v IS NULL) AS n_missing, round(avg(v), 6) AS mean, min(v) AS least, max(v) AS most,
       true AS distinct_close, true AS quantiles_close, 3 AS n_quantiles
FROM (SELECT unnest(['value', 'user_id']) AS c, unnest([value, user_id]) AS v FROM events) GROUP BY 1
""")
def merged_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of each event type stored, then merged without another look at the events; checked by exact figures."""
    events = table(spark, folder, "events")
    names = ["value", "user_id"]
    stored = frozen(sketches.sketched(events, names, F.col("event_type")), "sketches")
    found = frozen(sketches.estimates(sketches.merged(stored), [0.1, 0.5, 0.9]), "estimates")
    exact = profile.count_distinct(events.select(F.col("value"), F.col("user_id").cast("double").alias("user_id")), names)
    asked = found.select("column", F.explode("quantiles").alias("q")).select("column", "q.*")
    cells = events.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot([], names, "column", "cell")
    ranks = cells.join(F.broadcast(asked), "column").groupBy("column", "prob").agg(
        F.avg((F.col("cell") < F.col("value")).cast("int")).alias("under"), F.avg((F.col("cell") <= F.col("value")).cast("int")).alias("upto"))
    error = sketches.RANK_ERROR
    good = ranks.groupBy("column").agg(
        F.every((F.col("under") <= F.col("prob") + error) & (F.col("upto") >= F.col("prob") - error)).alias("quantiles_close"))
    near = F.abs(F.col("found.n_distinct") - F.col("exact.n_distinct")) <= sketches.DISTINCT_ERROR * F.col("exact.n_distinct")
    joined = found.alias("found").join(F.broadcast(exact).alias("exact"), "column").join(F.broadcast(good), "column")
    return rounded(joined.select(
        "column", "n", "n_missing", "mean", "least", "most", near.alias("distinct_close"), "quantiles_close", F.size("quantiles").alias("n_quantiles")
    ), 6, "mean")


def _poly_sql(x: str, coefficients: tuple[float, ...]) -> str:
    value = f"({coefficients[0]}::double)"
    for c in coefficients[1:]:
        value = f"({value} * {x} + {c}::double)"
    return value


def _quantile_sql(p: str) -> str:
    """``shapes.normal_quantile`` in SQL."""
    def tail(share: str) -> str:
        q = f"sqrt(-2.0::double * ln({share}))"
        return f"({_poly_sql(q, shapes.TAIL[0])} / {_poly_sql(q, shapes.TAIL[1])})"

    near = f"({p} - 0.5::double)"
    middle = f"({near} * {_poly_sql(f'({near} * {near})', shapes.MIDDLE[0])} / {_poly_sql(f'({near} * {near})', shapes.MIDDLE[1])})"
    return (f"CASE WHEN {p} < {shapes.TAIL_FROM} THEN {tail(p)} WHEN {p} > {1 - shapes.TAIL_FROM} "
            f"THEN -{tail(f'(1.0::double - {p})')} ELSE {middle} END")


@query(f"""
WITH ranked AS (
  SELECT event_type, value, count(*) OVER (PARTITION BY event_type) AS whole,
         rank() OVER (PARTITION BY event_type ORDER BY value) - 1 AS smaller, count(*) OVER (PARTITION BY event_type, value) AS tied
  FROM events WHERE value IS NOT NULL),
placed AS (SELECT *, ((smaller + (tied + 1) / 2.0::double) - 0.375::double) / (whole + 0.25::double) AS p FROM ranked),
scored AS (SELECT event_type, value, {_quantile_sql('p')} AS m FROM placed),
tested AS (SELECT event_type, count(*) AS n, power(corr(value, m), 2) AS w FROM scored GROUP BY 1 HAVING count(*) > 500),
z AS (SELECT *, (ln(1 - w) - (-1.2725::double + 1.0521::double * (ln(ln(n)) - ln(n)))) / (1.0308::double - 0.26758::double * (ln(ln(n)) + 2 / ln(n))) AS z FROM tested)
SELECT event_type, n, round(w, 6) AS w, round(z, 3) AS z, z < 1.6448536269514722::double AS normal FROM z
""")
def rank_normality(spark: SparkSession, folder: str) -> DataFrame:
    found = shapes.rank_normality(table(spark, folder, "events"), ["event_type"], "value")
    return rounded(rounded(found, 6, "w"), 3, "z")


@query("""
WITH s AS (SELECT l_returnflag, count(*) AS n, stddev_samp(l_quantity::double) AS sd, min(l_quantity::double) AS lo, max(l_quantity::double) AS hi FROM lineitem GROUP BY 1),
b AS (SELECT l_returnflag, least(floor((l_quantity - lo) / ((hi - lo) / 512))::int, 511) AS bin, count(*) AS c FROM lineitem JOIN s USING (l_returnflag) GROUP BY 1, 2),
g AS (SELECT *, lo + i * ((hi - lo) / 49) AS x, sd * pow(n, -0.2::double) AS h FROM s, (SELECT unnest(range(50)) AS i))
SELECT l_returnflag, round(x, 6) AS x,
       round(sum(c * exp(-pow((x - (lo + (bin + 0.5::double) * ((hi - lo) / 512))) / h, 2) / 2)) / (max(n) * max(h) * sqrt(2 * pi())), 6) AS density
FROM g JOIN b USING (l_returnflag) GROUP BY l_returnflag, i, x
""")
def density_by_group(spark: SparkSession, folder: str) -> DataFrame:
    """A curve of quantities for every return flag at once."""
    return rounded(shapes.density_by_group(table(spark, folder, "lineitem"), ["l_returnflag"], "l_quantity"), 6, "x", "density")
