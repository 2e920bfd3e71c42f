"""The end-to-end jobs, fed with files and tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.plans import jobs
from prepkit.plans.rates import AGE_RATES_FINE, SEX_RATES
from prepkit.queries.cleaning import BRACKET_SQL, FINE_SQL
from prepkit.queries.registry import DIRTY, dirty, query, rounded, table, unit_sql
from prepkit.session import scratch_path
from prepkit.sources import writers

CENSUS_SQL = """
WITH c AS (SELECT 15 + c_custkey % 60 AS age, c_acctbal AS gain, c_custkey AS k,
  CASE c_nationkey % 5 WHEN 0 THEN 'Divorced' WHEN 1 THEN 'Never-married' WHEN 2 THEN 'Widowed' WHEN 3 THEN 'Separated' END AS status
  FROM customer),
d AS (SELECT age::int AS age, trunc(gain)::int AS gain, k, status FROM c WHERE status IS NOT NULL)
"""


def _census_files(spark: SparkSession, folder: str) -> str:
    """Customers written as headerless census lines with leading blanks."""
    status = F.get(F.array(*[F.lit(s) for s in (" Divorced", " Never-married", " Widowed", " Separated")]), F.col("c_nationkey") % 5)
    fixed = {"workclass": " Private", "education": " Bachelors", "occupation": " Sales", "relationship": " Husband",
             "race": " White", "sex": " Male", "native_country": " Other", "income": " <=50K"}
    numbers = {"age": F.lit(15) + F.col("c_custkey") % 60, "fnlwgt": F.col("c_custkey").cast("double"),
               "education_num": F.lit(13.0), "capital_gain": F.col("c_acctbal"), "capital_loss": F.lit(0.0),
               "hours_per_week": F.lit(40.0), "marital_status": status}
    names = [part.split(" ")[0] for part in jobs.CENSUS_SCHEMA.split(", ")]
    cells = {**numbers, **{c: F.lit(v) for c, v in fixed.items()}}
    path = scratch_path(spark, "census")
    writers.write_csv(table(spark, folder, "customer").select(*[cells[n].alias(n) for n in names]), path, header=False)
    return path


@query(CENSUS_SQL + "SELECT status AS marital_status, round(avg(gain), 6) AS average_capital_gain FROM d GROUP BY 1")
def census_gain(spark: SparkSession, folder: str) -> DataFrame:
    done = jobs.census(spark, _census_files(spark, folder))
    return rounded(done.gain_by_status, 6, "average_capital_gain")


@query(CENSUS_SQL + """
SELECT status AS marital_status, s AS marital_status_statistics, male, female, count(k) AS n, sum(gain * 1.0::double * gain) AS squares
FROM d FULL OUTER JOIN (VALUES ('Never-married', 47.35::double, 41.81::double), ('Married-AF-spouse', 67.54::double, 68.33::double),
  ('Widowed', 3.58::double, 11.61::double), ('Divorced', 10.82::double, 15.09::double)) r(s, male, female) ON status = s GROUP BY 1, 2, 3, 4
""")
def census_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The joined table summed up: rows and squared gains by status, unmatched ones of both sides kept."""
    joined = jobs.census(spark, _census_files(spark, folder)).joined
    by = ["marital_status", "marital_status_statistics", "male", "female"]
    return joined.groupBy(*by).agg(F.count("age").alias("n"), F.sum("capital_gain_x_capital_gain").alias("squares"))


@query(DIRTY + f"""
, m AS (SELECT avg(value) FILTER (value >= 100) AS m FROM dirty),
k AS (SELECT event_id, sex, age, CASE WHEN value IS NULL OR value < 100 THEN m ELSE value END AS trestbps, flag,
  {BRACKET_SQL} AS b, {FINE_SQL} * CASE WHEN sex = 'male' THEN 0.131::double / 0.101::double ELSE 1.0::double END AS p FROM dirty, m),
r AS (SELECT event_id, row_number() OVER (PARTITION BY sex, b ORDER BY {unit_sql('event_id', 'impute 42')}, event_id) AS i,
  count(*) OVER (PARTITION BY sex, b) AS n, p FROM k WHERE flag IS NULL)
SELECT event_id, round(trestbps, 6) AS trestbps,
  CASE WHEN flag IS NOT NULL THEN flag WHEN i <= round_even(n * r.p, 0) THEN 1 ELSE 0 END::double AS smoke
FROM k LEFT JOIN r USING (event_id)
""")
def heart_filled(spark: SparkSession, folder: str) -> DataFrame:
    """The heart-disease cleaning and the quota for smoking, on the events with gaps."""
    df = dirty(spark, folder)
    given = {"age": F.col("age"), "sex": (F.col("sex") == "male").cast("double"), "trestbps": F.col("value"), "smoke": F.col("flag")}
    columns = [given.get(c, F.lit(1.0)).cast("string").alias(c) for c in jobs.HEART_COLUMNS]
    clean = jobs.heart_clean(df.select("event_id", *columns), "event_id")
    filled = jobs.heart_fill_smoke(clean, "event_id", how="quota", sex=SEX_RATES, fine=AGE_RATES_FINE)
    return rounded(filled.select("event_id", "trestbps", "smoke"), 6, "trestbps")


@query(CENSUS_SQL + """
, m AS (SELECT unnest(['age', 'workclass', 'marital_status', 'capital_gain']) AS "column")
SELECT "column", CASE "column" WHEN 'marital_status' THEN (SELECT count(*) FILTER (status IS NULL) FROM c) ELSE 0 END AS n_missing FROM m
""")
def census_missing(spark: SparkSession, folder: str) -> DataFrame:
    found = jobs.census(spark, _census_files(spark, folder)).missing
    return found.where(F.col("column").isin("age", "workclass", "marital_status", "capital_gain"))


@query(CENSUS_SQL + """
SELECT 'divorced' AS part, count(*) AS n, sum(gain)::bigint AS gain FROM d WHERE status = 'Divorced'
UNION ALL SELECT '30 to 50', count(*), sum(gain)::bigint FROM d WHERE age BETWEEN 30 AND 50
""")
def census_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The divorced rows and those aged 30 to 50, summed up."""
    done = jobs.census(spark, _census_files(spark, folder))
    parts = [df.agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.sum("capital_gain").alias("gain"))
             for name, df in (("divorced", done.divorced), ("30 to 50", done.aged_30_to_50))]
    return parts[0].unionByName(parts[1])


@query("""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END, p_partkey) AS i FROM part)
SELECT p_name AS car_model, p_size::int AS year_of_manufacture, round_even(p_retailprice / 7.0::double, 2) AS price, p_brand AS fuel FROM p WHERE i = 1
""")
def used_cars(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as cars over files of three formats, the CSV columns in another order: the first of each model, prices rounded."""
    path = scratch_path(spark, "cars")
    cars = table(spark, folder, "part").select(
        F.col("p_name").alias("car_model"), F.col("p_size").cast("int").alias("year_of_manufacture"),
        (F.col("p_retailprice") / 7.0).alias("price"), F.col("p_brand").alias("fuel"), F.col("p_partkey").alias("k"),
    ).orderBy("k")
    part = F.col("year_of_manufacture") % 3
    writers.write_csv(cars.where(part == 0).select("fuel", "price", "year_of_manufacture", "car_model"), f"{path}/a")
    writers.write_jsonl(cars.where(part == 1).drop("k"), f"{path}/b")
    writers.write_xml(cars.where(part == 2).drop("k"), f"{path}/c")
    return jobs.used_cars(spark, path)


HEART_SQL = DIRTY + """
, h AS (SELECT event_id, age, CASE WHEN sex = 'male' THEN 1.0::double ELSE 0 END AS sex, value AS trestbps, value / 2 AS thalach,
  CASE WHEN event_id % 10 <> 0 THEN (event_id % 60) / 10.0::double END AS oldpeak, nullif(event_id % 23, 0)::double AS thaldur,
  flag::double AS fbs, CASE WHEN event_id % 9 <> 0 THEN (event_id % 2)::double END AS painloc,
  CASE WHEN event_id % 4 <> 0 THEN (event_id % 3 + 1)::double END AS slope, CASE WHEN event_id % 5 <> 0 THEN (event_id % 4 + 1)::double END AS cp FROM dirty),
fits AS (SELECT avg(trestbps) FILTER (trestbps >= 100) AS m1, avg(thalach) AS m2, avg(oldpeak) FILTER (oldpeak BETWEEN 0 AND 4) AS m3, avg(thaldur) AS m4,
  (SELECT fbs FROM h WHERE fbs <= 1 GROUP BY fbs ORDER BY count(*) DESC, fbs LIMIT 1) AS o1,
  (SELECT painloc FROM h WHERE painloc IS NOT NULL GROUP BY painloc ORDER BY count(*) DESC, painloc LIMIT 1) AS o2,
  (SELECT slope FROM h WHERE slope IS NOT NULL GROUP BY slope ORDER BY count(*) DESC, slope LIMIT 1) AS o3,
  (SELECT cp FROM h WHERE cp IS NOT NULL GROUP BY cp ORDER BY count(*) DESC, cp LIMIT 1) AS o4 FROM h)
"""


@query(HEART_SQL + """
SELECT event_id, round(CASE WHEN trestbps >= 100 THEN trestbps ELSE m1 END, 6) AS trestbps, round(coalesce(thalach, m2), 6) AS thalach,
  round(CASE WHEN oldpeak BETWEEN 0 AND 4 THEN oldpeak ELSE m3 END, 6) AS oldpeak, round(coalesce(thaldur, m4), 6) AS thaldur,
  CASE WHEN fbs <= 1 THEN fbs ELSE o1 END AS fbs, coalesce(painloc, o2) AS painloc, coalesce(slope, o3) AS slope, coalesce(cp, o4) AS cp
FROM h, fits
""")
def heart_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The heart-disease cleaning with gaps and bad values in the columns it repairs by means and by modes."""
    k = F.col("event_id")
    df = dirty(spark, folder)
    given = {
        "age": F.col("age"), "sex": (F.col("sex") == "male").cast("double"), "trestbps": F.col("value"), "thalach": F.col("value") / 2,
        "oldpeak": F.when(k % 10 != 0, (k % 60) / 10.0), "thaldur": F.nullif(k % 23, F.lit(0)), "fbs": F.col("flag"),
        "painloc": F.when(k % 9 != 0, k % 2), "slope": F.when(k % 4 != 0, k % 3 + 1), "cp": F.when(k % 5 != 0, k % 4 + 1),
    }
    columns = [given.get(c, F.lit(1.0)).cast("string").alias(c) for c in jobs.HEART_COLUMNS]
    clean = jobs.heart_clean(df.select("event_id", *columns), "event_id")
    numbers = ["trestbps", "thalach", "oldpeak", "thaldur"]
    return rounded(clean.select("event_id", *numbers, "fbs", "painloc", "slope", "cp"), 6, *numbers)


@query(HEART_SQL + """
, c AS (SELECT event_id, CASE WHEN trestbps >= 100 THEN trestbps ELSE m1 END AS x FROM h, fits),
q AS (SELECT quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b FROM c),
k AS (SELECT CASE WHEN x BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a) THEN x END AS x FROM c, q),
f AS (SELECT coalesce(x, (SELECT x FROM k WHERE x IS NOT NULL GROUP BY x ORDER BY count(*) DESC, x LIMIT 1)) AS x FROM k)
SELECT round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS median, round(quantile_cont(x, 0.75), 6) AS q3 FROM f
""")
def heart_profiled(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of the cleaned heart columns: the box of blood pressure after masking and filling."""
    k = F.col("event_id")
    columns = [(F.col("value") if c == "trestbps" else (k % 2).cast("double") if c in jobs.HEART_ROLES.binary else F.lit(1.0)).cast("string").alias(c)
               for c in jobs.HEART_COLUMNS]
    clean = jobs.heart_clean(dirty(spark, folder).select("event_id", *columns), "event_id")
    boxes = jobs.heart_profile(clean, jobs.HEART_ROLES)["boxes"].where(F.col("column") == "trestbps")
    return rounded(boxes.select("q1", "median", "q3"), 6, "q1", "median", "q3")


def _heart_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events cleaned as heart rows: four columns of numbers, four of codes, all with gaps and spread before."""
    k = F.col("event_id")
    given = {
        "age": F.col("age"), "sex": (F.col("sex") == "male").cast("double"), "trestbps": F.col("value"), "thalach": F.col("value") / 2,
        "oldpeak": F.when(k % 10 != 0, (k % 60) / 10.0), "thaldur": F.nullif(k % 23, F.lit(0)), "fbs": F.col("flag"),
        "painloc": F.when(k % 9 != 0, k % 2), "slope": F.when(k % 4 != 0, k % 3 + 1), "cp": F.when(k % 5 != 0, k % 4 + 1),
    }
    columns = [given.get(c, F.lit(1.0)).cast("string").alias(c) for c in jobs.HEART_COLUMNS]
    return jobs.heart_clean(dirty(spark, folder).select("event_id", *columns), "event_id")


PROFILED = {"age": "age::double", "trestbps": "CASE WHEN trestbps >= 100 THEN trestbps ELSE m1 END", "thaldur": "coalesce(thaldur, m4)",
            "thalach": "coalesce(thalach, m2)", "oldpeak": "CASE WHEN oldpeak BETWEEN 0 AND 4 THEN oldpeak ELSE m3 END"}
PROFILE_SQL = HEART_SQL + ", c AS (SELECT event_id, " + ", ".join(f"{x} AS {c}" for c, x in PROFILED.items()) + " FROM h, fits)" + "".join(f"""
, q_{c} AS (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM c)
, k_{c} AS (SELECT event_id, CASE WHEN {c} BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a) THEN {c} END AS x FROM c, q_{c})
, m_{c} AS (SELECT x AS m FROM k_{c} WHERE x IS NOT NULL GROUP BY x ORDER BY count(*) DESC, x LIMIT 1)""" for c in PROFILED) + """
, filled AS (SELECT event_id, """ + ", ".join(f"coalesce(k_{c}.x, (SELECT m FROM m_{c})) AS {c}" for c in PROFILED) + """
  FROM k_age """ + " ".join(f"JOIN k_{c} USING (event_id)" for c in PROFILED if c != "age") + ")"


@query(PROFILE_SQL + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN NOT isnan(corr({a}, {b})) THEN round(corr({a}, {b}), 6) END AS r, count(*) AS n FROM filled"
    for i, a in enumerate(PROFILED) for b in list(PROFILED)[i + 1:]))
def heart_profile_correlations(spark: SparkSession, folder: str) -> DataFrame:
    found = jobs.heart_profile(_heart_events(spark, folder), jobs.HEART_ROLES)["correlations"]
    return rounded(found, 6, "r")


@query(PROFILE_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3
FROM filled""" for c in PROFILED))
def heart_profile_boxes(spark: SparkSession, folder: str) -> DataFrame:
    found = jobs.heart_profile(_heart_events(spark, folder), jobs.HEART_ROLES)["boxes"]
    return rounded(found.select("column", "q1", "median", "q3"), 6, "q1", "median", "q3")


@query(HEART_SQL + ", v AS (SELECT coalesce(CASE WHEN fbs <= 1 THEN fbs END, o1) AS fbs, coalesce(painloc, o2) AS painloc, coalesce(slope, o3) AS slope, "
       "coalesce(cp, o4) AS cp FROM h, fits) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c}::varchar AS value, count(*) AS n FROM v GROUP BY 2""" for c in ("fbs", "painloc", "slope", "cp")))
def heart_profile_counts(spark: SparkSession, folder: str) -> DataFrame:
    found = jobs.heart_profile(_heart_events(spark, folder), jobs.HEART_ROLES)["counts"]
    return found.where(F.col("column").isin("fbs", "painloc", "slope", "cp"))


RATE_PAGES_SQL = "WITH r AS (SELECT c_custkey, (c_custkey % 90)::int AS k FROM customer) "


def _rate_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as the two stored ones are built, a figure of each customer in them; dashes as character references."""
    k = (F.col("c_custkey") % 90).cast("int").cast("string")
    cut = [[F.lit(t) if t != "K" else k for t in part.split("~")] for part in (
        '<ul class="wide block-list"><li>first</li></ul><ul class="block-list"><li>About one in ten <b>men</b> (~K~.5%)</li>'
        "<li>women (~K~.1%)</li></ul>",
        '<ul class="block-list"><li>aged 18&ndash;24 years (~K~.2%)</li><li>aged 25&#8211;44 years (~K~.4%)</li>'
        "<li>aged 65 years and older (~K~.3%)</li><li>others (1%)</li></ul>",
        '<div class="chart-data-wrapper"><pre class="chart-caption">' + jobs.RATE_CAPTION + '</pre><pre class="chart-data">[[1],[2],[3],[4],[5],[6],[7],'
        "[[~K~.6,0.1],[~K~.7,0.2,0.3],[1.5]]]</pre></div>",
    )]
    html = F.concat(*[x for part in cut for x in part])
    return table(spark, folder, "customer").select("c_custkey", html.alias("html"))


def _rates(df: DataFrame, by: str) -> DataFrame:
    return rounded(df.groupBy(by).agg(F.count("*").alias("n"), F.sum("percentage").alias("total")), 6, "total")


@query(RATE_PAGES_SQL + """
SELECT 'male' AS gender, count(*) AS n, round(sum((k + 0.5) / 100.0::double), 6) AS total FROM r
UNION ALL SELECT 'female', count(*), round(sum((k + 0.1) / 100.0::double), 6) FROM r
""")
def rates_by_sex(spark: SparkSession, folder: str) -> DataFrame:
    return _rates(jobs.sex_rates(_rate_pages(spark, folder)), "gender")


@query(RATE_PAGES_SQL + """
SELECT '18–24 years' AS age_range, count(*) AS n, round(sum((k + 0.2) / 100.0::double), 6) AS total FROM r
UNION ALL SELECT '25–44 years', count(*), round(sum((k + 0.4) / 100.0::double), 6) FROM r
UNION ALL SELECT '65 years and older', count(*), round(sum((k + 0.3) / 100.0::double), 6) FROM r
""")
def rates_by_coarse_age(spark: SparkSession, folder: str) -> DataFrame:
    return _rates(jobs.age_rates_coarse(_rate_pages(spark, folder)), "age_range")


@query(RATE_PAGES_SQL + """
SELECT '15-17' AS age_range, count(*) AS n, round(sum((k + 0.6) / 100.0::double), 6) AS total FROM r
UNION ALL SELECT '18-24', count(*), round(sum((k + 0.7) / 100.0::double), 6) FROM r
UNION ALL SELECT '25-34', count(*), round(sum(0.015::double), 6) FROM r
""")
def rates_by_fine_age(spark: SparkSession, folder: str) -> DataFrame:
    return _rates(jobs.age_rates_fine(_rate_pages(spark, folder)), "age_range")


def _flights(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The flight job on items: quantity for distance, price for air time, tax and discount for delays, some missing."""
    flights = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("Distance"), F.col("l_extendedprice").alias("AirTime"),
        F.col("l_tax").alias("DepDelay"), F.when(F.col("l_linestatus") == "O", F.col("l_discount")).alias("ArrDelay"),
        F.when(F.col("l_returnflag") == "R", F.col("l_tax")).alias("LateAircraftDelay"),
    )
    return jobs.flights(flights, 10.0, ["DepDelay", "ArrDelay", "LateAircraftDelay"])


FLIGHTS_SQL = """
WITH f AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity AS d, l_extendedprice AS a, l_tax AS dep,
  CASE WHEN l_linestatus = 'O' THEN l_discount END AS arr, CASE WHEN l_returnflag = 'R' THEN l_tax END AS late FROM lineitem)
"""


@query(FLIGHTS_SQL + """
SELECT CASE WHEN arr IS NOT NULL AND late IS NOT NULL THEN 'Both' WHEN arr IS NOT NULL THEN 'Only Arrival' ELSE 'Only Late Aircraft' END AS type,
  count(*) AS n, round(sum(coalesce(arr, 0)), 4) AS arr, round(sum(coalesce(late, 0)), 4) AS late
FROM f WHERE arr IS NOT NULL OR late IS NOT NULL GROUP BY 1
""")
def flights_by_pattern(spark: SparkSession, folder: str) -> DataFrame:
    found = _flights(spark, folder)["pattern"].groupBy("type").agg(
        F.count("*").alias("n"), F.sum("ArrDelay").alias("arr"), F.sum("LateAircraftDelay").alias("late"))
    return rounded(found, 4, "arr", "late")


def _pair_sql(test: str) -> str:
    cells = {"DepDelay": "dep", "ArrDelay": "arr", "LateAircraftDelay": "late"}
    rows = []
    for a, b in (("DepDelay", "ArrDelay"), ("DepDelay", "LateAircraftDelay"), ("ArrDelay", "LateAircraftDelay")):
        x, y = (f"CASE WHEN {cells[c]} {test} 0 THEN {cells[c]} END" for c in (a, b))
        rows.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({x}, {y}), 6) AS r, count(*) FILTER (({x}) IS NOT NULL AND ({y}) IS NOT NULL) AS n FROM f")
    return FLIGHTS_SQL + " UNION ALL ".join(rows)


@query(_pair_sql(">"))
def flight_correlations(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_flights(spark, folder)["correlations"], 6, "r")


@query(_pair_sql(">="))
def flight_correlations_from_zero(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_flights(spark, folder)["correlations_from_zero"], 6, "r")


def _box_sql(source: str) -> str:
    rows = []
    for name, c in (("DepDelay", "dep"), ("ArrDelay", "arr"), ("LateAircraftDelay", "late")):
        rows.append(f"""SELECT '{name}' AS "column", round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
          round(min(x) FILTER (x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
          round(max(x) FILTER (x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
          count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers
        FROM (SELECT {c} AS x FROM {source}), (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM {source})
        GROUP BY q1, q2, q3""")
    return FLIGHTS_SQL + """, late_ones AS (SELECT * FROM f WHERE dep >= 0 AND arr >= 0),
  positive_ones AS (SELECT CASE WHEN dep > 0 THEN dep END AS dep, CASE WHEN arr > 0 THEN arr END AS arr, CASE WHEN late > 0 THEN late END AS late FROM f)
""" + " UNION ALL ".join(rows)


BOX_FIGURES = ("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")


@query(_box_sql("f"))
def flight_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_flights(spark, folder)["boxes"], 6, *BOX_FIGURES)


@query(_box_sql("late_ones"))
def flight_late_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_flights(spark, folder)["late_boxes"], 6, *BOX_FIGURES)


@query(FLIGHTS_SQL + """
SELECT 'Distance' AS "column", round(sum(power(d - m, 3)) / count(*) / power(var_pop(d), 1.5), 5) AS skew,
  round(sum(power(d - m, 4)) / count(*) / power(var_pop(d), 2) - 3, 5) AS kurtosis FROM f, (SELECT avg(d) AS m FROM f)
UNION ALL SELECT 'AirTime', round(sum(power(a - m, 3)) / count(*) / power(var_pop(a), 1.5), 5),
  round(sum(power(a - m, 4)) / count(*) / power(var_pop(a), 2) - 3, 5) FROM f, (SELECT avg(a) AS m FROM f)
""")
def flight_shape(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_flights(spark, folder)["shape"], 5, "skew", "kurtosis")


@query("""
WITH f AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity AS d, l_extendedprice AS a FROM lineitem)
SELECT (ceil(d / 10.0::double) - 1)::int AS bin, round(avg(a), 4) AS mean, round(stddev_samp(a), 4) AS std, round(skewness(a), 5) AS skew,
  count(*) AS n, round(quantile_cont(a, 0.5), 4) AS median FROM f GROUP BY 1
""")
def flights_by_distance(spark: SparkSession, folder: str) -> DataFrame:
    """The flight job's binned figures, with quantity for distance and price for air time."""
    flights = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("Distance"), F.col("l_extendedprice").alias("AirTime"),
        F.col("l_tax").alias("DepDelay"), F.col("l_discount").alias("ArrDelay"),
        F.when(F.col("l_returnflag") == "R", F.col("l_tax")).alias("LateAircraftDelay"),
    )
    done = jobs.flights(flights, 10.0, ["DepDelay", "ArrDelay", "LateAircraftDelay"])["by_distance"]
    return rounded(rounded(done, 4, "mean", "std", "median"), 5, "skew")


@query(_box_sql("positive_ones"))
def flight_positive_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_flights(spark, folder)["positive_boxes"], 6, *BOX_FIGURES)


@query(FLIGHTS_SQL + "SELECT 'Distance' AS col_a, 'AirTime' AS col_b, round(corr(d, a), 6) AS r, count(*) AS n FROM f")
def flight_distance_air_time(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_flights(spark, folder)["distance_air_time"], 6, "r")


@query(FLIGHTS_SQL + """
, b AS (SELECT (ceil(d / 10.0::double) - 1)::int AS bin, a FROM f), m AS (SELECT bin, avg(a) AS m, var_pop(a) AS v, count(*) AS n FROM b GROUP BY bin),
g AS (SELECT bin, max(n) AS n, avg(power(a - m, 3)) / power(max(v), 1.5) AS s, avg(power(a - m, 4)) / power(max(v), 2) - 3 AS k FROM b JOIN m USING (bin) GROUP BY bin),
j AS (SELECT bin, n, n / 6.0::double * (s * s + k * k / 4) AS jb FROM g WHERE n > 500)
SELECT bin, n, round(jb, 4) AS jb, round(exp(-jb / 2), 6) AS p, exp(-jb / 2) > 0.05 AS normal FROM j
""")
def flight_normality(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(rounded(_flights(spark, folder)["normality"], 4, "jb"), 6, "p")


@query(FLIGHTS_SQL + """
, b AS (SELECT (ceil(d / 10.0::double) - 1)::int AS bin, a FROM f),
q AS (SELECT bin, quantile_cont(a, 0.25) AS q1, quantile_cont(a, 0.5) AS q2, quantile_cont(a, 0.75) AS q3 FROM b GROUP BY bin)
SELECT bin, round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
  round(min(a) FILTER (a BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round(max(a) FILTER (a BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  count(*) FILTER (a NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM b JOIN q USING (bin) GROUP BY bin, q1, q2, q3
""")
def flight_violins(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_flights(spark, folder)["violins"], 6, *BOX_FIGURES)
