import corpus_pipeline
import pytest

from prepkit.llm import registry
from prepkit.sources.frozen import release

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns over the smallest tables."""
    from prepkit.llm.shared import stored
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        out.append((name, docs))
    return out


def test_each_stage_does_its_work_on_what_was_kept(spark, stages):
    names = [n for n, _ in stages]
    assert names == ["documents", "toxicity", "line_dedup", "ngram_jaccard", "decontaminate", "mix_sources"]
    start = stages[0][1]
    for name, df in stages[1:-1]:
        assert df.columns == start.columns
        assert df.dtypes == start.dtypes
    sets = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in stages}
    assert all(sets[b] <= sets[a] for a, b in zip(names, names[1:]))
    assert sets["line_dedup"] == sets["toxicity"]
    by = dict(stages)
    from prepkit.llm import decontam, line_dedup, near_dup, toxicity
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    rejected = toxicity.scored(start, labels).where("predicted = 1")
    assert sets["toxicity"] == sets["documents"] - {r.doc_id for r in rejected.collect()}
    assert line_dedup.line_dedup(by["line_dedup"]).agg({"n_dropped": "sum"}).first()[0] == 0
    classes = near_dup.jaccard_classes(by["line_dedup"]).collect()
    assert sets["ngram_jaccard"] == {r.doc_id for r in classes if r.kept}
    bad = decontam.decontamination(by["ngram_jaccard"], items).where("contaminated")
    assert sets["decontaminate"] == sets["ngram_jaccard"] - {r.doc_id for r in bad.collect()}
    assert by["mix_sources"].where("copies NOT BETWEEN 1 AND 3").count() == 0


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, stages[-1][1].collect()))


def test_stages_take_empty_and_odd_tables(spark, odd, empty):
    for docs in (empty, odd):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.columns == [c for c in odd.columns if c != "copies"] + ["copies"]
        docs.collect()


def test_queries_with_sql_equal_it(spark):
    from tests.twin import oracle, table_of
    con = oracle(SF)
    for name, sql in registry.SQL.items():
        df, found = registry.QUERIES[name](spark, SF), con.execute(sql)
        assert table_of(df.columns, df.collect()) == table_of([d[0] for d in found.description], found.fetchall()), name


def test_written_tables_can_be_released(spark):
    registry.QUERIES["op7_mix_sources"](spark, SF).collect()
    assert release(spark) > 0 and release(spark) == 0
