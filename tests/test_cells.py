import math

import pytest
from pyspark.sql import functions as F

from prepkit.functions import cells, chance, markup


def values(spark, data, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*exprs).collect()]


def test_to_number_turns_bad_text_into_null(spark):
    found = values(spark, [("1.5",), ("abc",), (None,), ("",)], "x string", cells.to_number("x"))
    assert found == [(1.5,), (None,), (None,), (None,)]


def test_half_even_takes_ties_to_the_even_neighbour(spark):
    found = values(spark, [(0.125,), (0.375,), (2.5,)], "x double", cells.half_even("x", 2), cells.half_even("x", 0))
    assert [f[0] for f in found] == [0.12, 0.38, 2.5]
    assert found[2][1] == 2.0


@pytest.mark.parametrize("given, wanted", [
    (None, 0.0), (1.0, 1.0), (6.0, 6.0), (7.0, 12.0), (8.0, 5.0), (12.0, 1.0), (25.0, 6.0), (300.0, 17.0), (13.0, 13.0),
])
def test_protocol_codes(spark, given, wanted):
    assert values(spark, [(given,)], "x double", cells.recode("x", cells.PROTOCOL_RULES)) == [(wanted,)]


def test_recode_default_and_plain_value(spark):
    found = values(spark, [("a",), ("b",)], "x string", cells.recode("x", [("a", "A")], "other"))
    assert found == [("A",), ("other",)]


@pytest.mark.parametrize("age, fine, coarse", [
    (14, None, None), (15, "15-17", None), (17, "15-17", None), (18, "18-24", "18–24 years"), (24, "18-24", "18–24 years"),
    (25, "25-34", "25–44 years"), (64, "55-64", "45–64 years"), (65, "65-74", "65 years and older"),
    (75, "75+", "65 years and older"), (None, None, None),
])
def test_bracket_edges(spark, age, fine, coarse):
    found = values(spark, [(age,)], "age int", cells.bracket("age", cells.AGE_BRACKETS_FINE),
                   cells.bracket("age", cells.AGE_BRACKETS_COARSE))
    assert found == [(fine, coarse)]


def test_fixed_bins_are_right_closed(spark):
    data = [(0.0,), (0.1,), (50.0,), (50.1,), (100.0,), (100.1,), (-3.0,), (None,)]
    found = values(spark, data, "x double", cells.fixed_bin("x", 50, 2))
    assert [f[0] for f in found] == [None, 0, 0, 1, 1, None, None, None]


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumn("u", chance.unit("id", 42)).withColumn("g", chance.gaussian("id", 1, 2.0))
    one = sorted(map(tuple, df.repartition(1).collect()))
    assert one == sorted(map(tuple, spark.range(2000).repartition(7).withColumn("u", chance.unit("id", 42))
                             .withColumn("g", chance.gaussian("id", 1, 2.0)).collect()))
    us, gs = [r[1] for r in one], [r[2] for r in one]
    assert all(0 <= u < 1 for u in us) and abs(sum(us) / len(us) - 0.5) < 0.03
    mean = sum(gs) / len(gs)
    assert abs(mean) < 0.15 and abs(math.sqrt(sum((g - mean) ** 2 for g in gs) / len(gs)) - 2.0) < 0.15


def test_percent_reads_between_the_first_brackets(spark):
    data = [("Men (13.1%) smoke",), ("none",), ("two (5%) and (7%)",), ("bad (x%)",)]
    assert values(spark, data, "t string", markup.percent("t")) == [(pytest.approx(0.131),), (None,), (0.05,), (None,)]


PAGE = """<html><ul class="other"><li>zero</li></ul><ul class="block-list wide"><li>first (1%)</li></ul>
<ul class='block-list'><li>nearly <b>13</b> men (13.1%)</li>
<li>women (10.1%)</li></ul>
<div class="chart-data-wrapper"><pre class="chart-caption">Other</pre><pre class="chart-data">[[1]]</pre></div>
<div class="chart-data-wrapper"><pre class="chart-caption">Daily smokers by age, 2022</pre>
<pre class="chart-data">[["15-17","18-24"],[[1.6,0.4],[7.3,1.1]]]</pre></div></html>"""


def test_lists_and_charts_of_a_page(spark):
    found = values(spark, [(PAGE,), ("<p>nothing</p>",)], "html string", markup.list_items("html", 1, "block-list"),
                   markup.captioned_series("html", "smokers by age", 1))
    assert found[0][0] == ["nearly 13 men (13.1%)", "women (10.1%)"]
    assert found[0][1] == [pytest.approx(0.016), pytest.approx(0.073)]
    assert found[1] == (None, None)


def test_character_references_are_decoded(spark):
    data = [("18&ndash;24 years",), ("a &lt;b&gt; &amp;lt; &#8211;&#x41;!",), ("&#0; &nope; & plain",), (None,)]
    got = values(spark, data, "t string", markup.decoded("t"))
    assert got == [("18\u201324 years",), ("a <b> &lt; \u2013A!",), ("&#0; &nope; & plain",), (None,)]


def test_a_class_is_taken_literally(spark):
    page = '<ul class="a.b"><li>dot</li></ul><ul class="axb"><li>x</li></ul>'
    assert values(spark, [(page,)], "html string", markup.list_items("html", 0, "a.b")) == [(["dot"],)]
    assert values(spark, [(page,)], "html string", markup.list_items("html", 1, "a.b")) == [(None,)]


def test_nan_lies_in_no_range(spark):
    got = values(spark, [(float("nan"),), (80.0,)], "x double", cells.bracket("x", cells.AGE_BRACKETS_FINE), cells.inside("x", 0, None))
    assert got == [(None, False), ("75+", True)]


def test_tokens_keep_empty_ones(spark):
    df = spark.createDataFrame([("a  b\n c",)], "t string").select(F.explode(markup.tokens("t")))
    assert [r[0] for r in df.collect()] == ["a", "", "b", "", "c"]
