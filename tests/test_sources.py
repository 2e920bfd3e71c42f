import gzip
import json

import pytest
from pyspark.sql import functions as F

from prepkit.operators.rows import first_per_key
from prepkit.plans import jobs
from prepkit.sources import readers, stage, writers
from prepkit.streaming import files as streaming

CARS = "car_model string, year_of_manufacture int, price double, fuel string"


@pytest.fixture
def cars(tmp_path):
    """Files of the three formats; the same model stands in several of them."""
    (tmp_path / "b.csv").write_text("car_model,year_of_manufacture,price,fuel\nritz,2014,5000.125,Petrol\n800,2003,7089.552238805970,CNG\n")
    (tmp_path / "a.csv").write_text("car_model,year_of_manufacture,price,fuel\nswift,2013,4.375,Diesel\nswift,2012,9.0,Petrol\n")
    lines = [{"car_model": "ritz", "year_of_manufacture": 2011, "price": 1.0, "fuel": "Diesel"},
             {"car_model": "alto", "year_of_manufacture": 2016, "price": 2.5, "fuel": "Petrol"}]
    (tmp_path / "c.json").write_text("\n".join(map(json.dumps, lines)))
    row = "<row><car_model>{}</car_model><year_of_manufacture>{}</year_of_manufacture><price>{}</price><fuel>Petrol</fuel></row>"
    (tmp_path / "d.xml").write_text('<?xml version="1.0"?>\n<root>\n' + row.format("alto", 2010, 3.0) + "\n" + row.format("wagon", 2010, 8.125) + "\n</root>")
    (tmp_path / "notes.txt").write_text("not a table")
    return str(tmp_path)


def test_folder_of_three_formats(spark, cars):
    whole = readers.ingest_folder(spark, cars, CARS)
    assert whole.count() == 8
    assert whole.groupBy("src_rank").count().count() == 3
    got = {r["car_model"]: (r["year_of_manufacture"], r["price"]) for r in jobs.used_cars(spark, cars).collect()}
    assert got == {"swift": (2013, 4.38), "ritz": (2014, 5000.12), "800": (2003, 7089.55), "alto": (2016, 2.5), "wagon": (2010, 8.12)}


def test_folder_without_tables(spark, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        readers.ingest_folder(spark, str(tmp_path), CARS)


def test_reading_order_of_a_large_file(spark, tmp_path):
    """A file cut into many splits still yields its first line first."""
    (tmp_path / "big.csv").write_text("k,v\n" + "".join(f"{i % 3},{i}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        whole = readers.ingest_folder(spark, str(tmp_path), "k int, v int")
        assert whole.rdd.getNumPartitions() > 3
        got = first_per_key(whole, ["k"], readers.READING_ORDER)
        assert {r["k"]: r["v"] for r in got.collect()} == {0: 0, 1: 1, 2: 2}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_listing_and_picking(spark, cars):
    assert readers.list_inputs(spark, cars, "*.csv").count() == 2
    assert readers.pick_input(spark, cars, "*.csv").endswith("/a.csv")
    assert readers.pick_input(spark, cars, "*.parquet") is None


def test_csv_ways(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_csv(spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "k int, s string, v double"), path)
    assert [t for _, t in readers.read_csv(spark, path).dtypes] == ["string"] * 3
    assert [t for _, t in readers.read_csv(spark, path, infer=True).dtypes] == ["int", "string", "double"]
    assert readers.read_csv(spark, path, schema="k int, s string, v double", max_rows=1).count() == 1


def test_malformed_rows_are_set_aside(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,v\n1,2.0\nbad,3.0\n3,4.0,5\n4,NaN\n")
    good, bad = readers.read_csv_checked(spark, str(tmp_path / "t.csv"), "k int, v double")
    assert sorted(map(tuple, good.collect())) == [(1, 2.0), (4, None)]
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["3,4.0,5", "bad,3.0"]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n2,1\n")
    (tmp_path / "b.csv").write_text("a,c,b\n3,x,4\n")
    (tmp_path / "c.csv").write_text("a\n5\n")
    got = readers.read_csv(spark, str(tmp_path), schema="a int, b int")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 2), (3, 4), (5, None)]
    good, bad = readers.read_csv_checked(spark, str(tmp_path / "a.csv"), "a int, b int")
    assert (good.collect(), bad.collect()) == ([(1, 2)], [])
    assert sorted(tuple(r)[:2] for r in readers.ingest_folder(spark, str(tmp_path), "a int, b int").collect())[0] == (1, 2)


def test_folder_with_packed_and_loud_names(spark, tmp_path):
    (tmp_path / "A.CSV").write_text("k,v\n1,1.0\n")
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(b"v,k\n2.0,2\n"))
    (tmp_path / "c.jsonl").write_text('{"k": 3, "v": 3.0}\n')
    (tmp_path / "d.json.gz").write_bytes(gzip.compress(b'{"k": 4, "v": 4.0}\n'))
    (tmp_path / "x.dat").write_text("?")
    with pytest.warns(UserWarning, match="1 files of no known format"):
        whole = readers.ingest_folder(spark, str(tmp_path), "k int, v double")
    assert sorted((r["k"], r["v"]) for r in whole.collect()) == [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)]


def test_nan_of_a_stored_table_is_missing(spark, tmp_path):
    spark.createDataFrame([(1.0,), (float("nan"),)], "x double").write.parquet(str(tmp_path / "p"))
    assert readers.read_parquet(spark, str(tmp_path / "p")).where("x IS NULL").count() == 1


def test_the_shared_folder(spark, monkeypatch):
    from prepkit import session
    from prepkit.sources.frozen import frozen, release

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster)
    Cluster.sparkContext.getCheckpointDir = staticmethod(lambda: "hdfs://mine")
    assert session.shared_folder(Cluster) == "hdfs://mine"
    before = spark.sparkContext.getCheckpointDir()
    session.ready_checkpoints(spark)
    assert spark.sparkContext.getCheckpointDir() == before
    kept = frozen(spark.range(3), "kept")
    assert kept.count() == 3 and release(spark) >= 1 and release(spark) == 0


def test_single_file(spark, tmp_path):
    path = tmp_path / "one"
    writers.write_single_csv(spark.range(10).repartition(4), str(path))
    assert len(list(path.glob("part-*.csv"))) == 1


def test_table_modes_and_dropping(spark):
    df = spark.createDataFrame([(1,)], "x int")
    writers.reset_schema(spark, "lab")
    writers.write_table(df, "lab.t")
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        writers.write_table(df, "lab.t", "fail")
    writers.write_table(df, "lab.t", "append")
    assert readers.read_table(spark, "lab.t", ["x"]).count() == 2
    writers.write_table(df, "lab.t", "replace")
    assert spark.table("lab.t").count() == 1
    writers.drop_table(spark, "lab.t")
    writers.drop_table(spark, "lab.t")
    assert not spark.catalog.tableExists("lab.t")
    with pytest.raises(ValueError):
        writers.reset_schema(spark, "default")


def test_stage_replaces_even_the_table_it_reads(spark):
    writers.reset_schema(spark, "steps")
    writers.write_table(spark.range(10).toDF("x"), "steps.a")
    done = stage.stage(spark, "steps.a", lambda df: {"steps.a": df.where("x < 4"), "steps.b": df.where("x >= 4")})
    assert done == ["steps.a", "steps.b"]
    assert (spark.table("steps.a").count(), spark.table("steps.b").count()) == (4, 6)
    stage.stage(spark, ["steps.a", "steps.b"], lambda dfs: {"steps.c": dfs[0].union(dfs[1])}, drops=["steps.a", "steps.b"])
    assert [t.name for t in spark.catalog.listTables("steps")] == ["c"]
    assert spark.table("steps.c").count() == 10
    with pytest.raises(ValueError):
        stage.stage(spark, None, lambda df: {})


def test_words_of_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("the cat  the dog\nthe end\n")
    (tmp_path / "b.txt").write_text("cat and cat  \n")
    got = {r["token"]: r["n"] for r in jobs.frequent_words(spark, f"{tmp_path}/*.txt").collect()}
    assert got == {"the": 3, "cat": 3, "": 3}


def test_stream_takes_new_files_once(spark, tmp_path):
    source, out, progress = (tmp_path / n for n in ("in", "out", "progress"))
    source.mkdir()

    def run():
        stream = streaming.arriving_files(spark, str(source), "k int, v double", header="true")
        query = streaming.clean_arriving(stream, lambda df: df.fillna(0.0, ["v"]), str(out), str(progress))
        query.awaitTermination()
        return sorted(map(tuple, spark.read.parquet(str(out)).collect()))

    (source / "a.csv").write_text("k,v\n1,1.5\n2,\n")
    assert run() == [(1, 1.5), (2, 0.0)]
    (source / "b.csv").write_text("k,v\n3,3.5\n")
    assert run() == [(1, 1.5), (2, 0.0), (3, 3.5)]


def test_stream_word_counts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("a b a\n")
    stream = streaming.arriving_files(spark, str(tmp_path / "in"), "value string", "text")
    out = str(tmp_path / "out")
    streaming.running_word_counts(stream, out, str(tmp_path / "p")).awaitTermination()
    assert {r["token"]: r["n"] for r in spark.read.parquet(out).collect()} == {"a": 2, "b": 1}
    (tmp_path / "in" / "b.txt").write_text("b c\n")
    again = streaming.arriving_files(spark, str(tmp_path / "in"), "value string", "text")
    streaming.running_word_counts(again, out, str(tmp_path / "p")).awaitTermination()
    assert {r["token"]: r["n"] for r in spark.read.parquet(out).collect()} == {"a": 2, "b": 2, "c": 1}


def test_rate_tables_from_stored_pages(spark):
    page = """<ul class="block-list"><li>x</li></ul>
    <ul class="block-list"><li>About 13 of 100 men (13.1%)</li><li>women (10.1%)</li></ul>
    <ul class="block-list"><li>aged 18–24 years (5.3%)</li><li>aged 65 years and older (8.3%)</li><li>other (1%)</li></ul>
    <div class="chart-data-wrapper"><pre class="chart-caption">CAPTION</pre>
    <pre class="chart-data">[[1],[1],[1],[1],[1],[1],[1],[[1.6],[7.3],[10.9],[10.9],[13.8],[14.9],[8.7],[2.9]]]</pre></div>"""
    pages = spark.createDataFrame([("u", page.replace("CAPTION", jobs.RATE_CAPTION))], "url string, html string")
    assert jobs.rate_map(jobs.sex_rates(pages)) == pytest.approx({"male": 0.131, "female": 0.101})
    assert jobs.rate_map(jobs.age_rates_coarse(pages)) == pytest.approx({"18–24 years": 0.053, "65 years and older": 0.083})
    from prepkit.plans.rates import AGE_RATES_FINE

    assert jobs.rate_map(jobs.age_rates_fine(pages)) == pytest.approx(AGE_RATES_FINE)


def test_census_job(spark, tmp_path):
    line = "{}, Private, 77516, Bachelors, 13, {}, Clerical, Husband, White, Male, {}, 0, 40, United-States, <=50K\n"
    (tmp_path / "c.csv").write_text(line.format(39, "Never-married", 2174) + line.format(50, "Divorced", 100)
                                    + line.format(51, "Divorced", 300) + line.format("", "Widowed", 5))
    done = jobs.census(spark, f"{tmp_path}/*.csv")
    assert done.data.count() == 3 and done.divorced.count() == 2
    assert {r["marital_status"]: r["average_capital_gain"] for r in done.gain_by_status.collect()} == {"Never-married": 2174.0, "Divorced": 200.0}
    assert {r["column"]: r["n_missing"] for r in done.missing.collect()}["age"] == 1
    assert done.joined.where("marital_status IS NULL").count() == 2
    assert done.aged_30_to_50.count() == 2
    assert done.data.first()["fnlwgt_x_fnlwgt"] == 77516.0 ** 2
    assert sum(c.count("_x_") for c in done.data.columns) == 21


def test_heart_profile(spark):
    from prepkit.operators.columns import Roles

    df = spark.range(200).select(
        "id", F.when(F.col("id") == 7, 900.0).otherwise((F.col("id") % 50).cast("double")).alias("chol"),
        F.when(F.col("id") % 4 > 0, (F.col("id") % 13).cast("double")).alias("proto"),
        F.when(F.col("id") % 9 == 0, 4.0).otherwise((F.col("id") % 2).cast("double")).alias("fbs"),
    )
    done = jobs.heart_profile(df, Roles(numerical=("chol",), categorical=("proto",), binary=("fbs",)))
    clean = done["clean"].toPandas()
    assert clean["chol"].max() < 100 and not clean.isna().any().any() and set(clean["fbs"]) == {0.0, 1.0}
    assert done["boxes"].first()["n_outliers"] == 0 and done["counts"].count() > 3
