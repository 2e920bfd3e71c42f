"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed place on a hash line. Words are summed by source and hash bucket; the bucket in which a
source's budget ends is refined by the next bits until one hash is left. What lies below the threshold is taken, by
a filter: nothing is sorted, a larger budget takes a superset, and runs agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepkit.llm.shared import stored

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, LEVEL_BITS = 60, 12


def place_of(id_col: str):
    """A document's place on the hash line, 0 to 2^60 - 1, from its id alone."""
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, place); a null text has size 0."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        place_of(id_col).alias("place"),
    )


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """(source, source_size, target): shares of all words by weight, none above ``max_repeats`` times its source.

    Sources take the weights in code point order, null last. By rising size for weight, a source is full if its share
    of what the ones before it left is above its limit; one pass over the sources finds all of them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = filling.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    listed = F.array(*[F.lit(int(w)) for w in weights])
    zero = F.lit(0).cast("long")
    shares = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(listed, (F.row_number().over(by_name) - 1) % len(weights)).cast("long"))
        .withColumn("limit", F.col("source_size") * max_repeats)
        .withColumn("words_left", F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), zero))
        .withColumn("weight_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), zero))
        .withColumn("full", F.col("limit") * F.col("weight_left") < F.col("weight") * F.col("words_left"))
    )
    rest = F.sum("source_size").over(every) - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(zero)).over(every)
    of = F.sum(F.when(F.col("full"), zero).otherwise(F.col("weight"))).over(every)
    share = F.col("weight").cast("double") * rest.cast("double") / of.cast("double")
    return shares.select(
        "source", "source_size", F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share).alias("target")
    )


def _thresholds(sizes: DataFrame, budgets: DataFrame, bits: int = LEVEL_BITS) -> DataFrame:
    """(source, below): documents of the source with a place under ``below`` make up its ``need`` words.

    Each level sums the words of one more slice of hash bits, only inside the bucket where the budget ends. The
    document at the very end is taken if that brings the sum nearer. A source whose budget never ends is left out.
    """
    found, frontier, shift = [], None, HASH_BITS
    while frontier is None or frontier.limit(1).count():
        last, shift = shift, max(0, shift - bits)
        if frontier is None:
            inside = sizes.join(budgets, sizes["source"].eqNullSafe(budgets["source"]))
            inside = inside.select(budgets["source"], "need", "size", "place")
        else:
            same = sizes["source"].eqNullSafe(frontier["source"])
            inside = sizes.join(frontier, same & (F.shiftright(sizes["place"], last) == frontier["bucket"]))
            inside = inside.select(frontier["source"], "need", "size", "place")
        sums = inside.groupBy("source", "need", F.shiftright("place", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("place").alias("low"), F.max("place").alias("high")
        )
        upto = Window.partitionBy("source").orderBy("bucket")
        ends = (
            sums.withColumn("upto", F.sum("words").over(upto))
            .where((F.col("upto") > F.col("need")) & (F.col("upto") - F.col("words") <= F.col("need")))
            .withColumn("need", F.col("need") - (F.col("upto") - F.col("words")))
        )
        ends = stored(ends.select("source", "need", "bucket", "words", "low", "high"), "mix-level")
        single = F.col("low") == F.col("high")
        found.append(ends.where(single).select(
            "source", (F.col("low") + F.when(F.col("need") * 2 >= F.col("words"), 1).otherwise(0)).alias("below")
        ))
        frontier = ends.where(~single).select("source", "need", "bucket")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def mix_plan(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """(source, source_size, target, copies, below) for each source: whole copies, and where one more ends.

    ``sizes`` comes from ``sized``. The frame has a row for each source and an empty one for an empty input.
    """
    targets = stored(source_targets(sizes, weights, max_repeats), "mix-targets")
    size, target = F.col("source_size"), F.col("target")
    whole = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("long")
    plan = targets.withColumn("copies", whole).withColumn("need", F.floor(target - whole * size).cast("long"))
    budgets = plan.where(F.col("need") > 0).select("source", "need")
    marks = _thresholds(sizes, budgets).withColumnRenamed("source", "at")
    return plan.join(marks, F.col("source").eqNullSafe(F.col("at")), "left").select(
        "source", "source_size", "target", "copies", F.coalesce("below", F.lit(0).cast("long")).alias("below")
    )


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies), a row for each row of ``docs``.

    ``taken`` is ``copies`` times ``size``. Null texts and texts without a word have size 0. Rows that share an id share
    their place and are taken together. A null id has a place like any other, a null source is a source of its own.
    Other columns are not read.
    """
    sizes = stored(sized(docs, id_col, text_col, source_col), "mix-sizes")
    plan = stored(mix_plan(sizes, weights, max_repeats), "mix-plan").withColumnRenamed("source", "at")
    copies = F.col("copies") + (F.col("place") < F.col("below")).cast("long")
    return sizes.join(plan, F.col("source").eqNullSafe(F.col("at"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies")
    )


def mixed(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``copies``, how often each is to be read, in place of such a column."""
    sizes = stored(sized(docs), "mix-sizes")
    plan = stored(mix_plan(sizes, weights, max_repeats), "mix-plan").select(
        F.col("source").alias("mix_at"), F.col("copies").alias("mix_copies"), F.col("below").alias("mix_below")
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "copies"]
    copies = F.col("mix_copies") + (place_of("doc_id") < F.col("mix_below")).cast("long")
    joined = docs.join(plan, F.col("source").cast("string").eqNullSafe(F.col("mix_at")))
    return joined.select(*kept, copies.alias("copies")).where("copies > 0")


SQL = """
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(sha256(doc_id::VARCHAR), 1, 15))::BIGINT AS place
  FROM documents),
sources AS (
  SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source)),
filling AS (
  SELECT *, 3 * source_size AS most,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS words_left,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM sources
  WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, most * weight_left < weight * words_left AS is_full FROM filling),
targets AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN most::DOUBLE
              ELSE weight::DOUBLE * (sum(source_size) OVER () - sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ())::DOUBLE
                   / (sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM flagged),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM targets),
needs AS (SELECT *, floor(target - copies * source_size)::BIGINT AS need FROM plan),
lined AS (
  SELECT source, place, words, sum(words) OVER (PARTITION BY source ORDER BY place) AS upto
  FROM (SELECT source, place, sum(size) AS words FROM docs GROUP BY source, place)),
ends AS (
  SELECT n.source, min(l.place) AS place,
         arg_min(l.words, l.place) AS words, arg_min(n.need - (l.upto - l.words), l.place) AS rest
  FROM needs n JOIN lined l ON n.source IS NOT DISTINCT FROM l.source
  WHERE n.need > 0 AND l.upto > n.need GROUP BY n.source)
SELECT d.doc_id, d.size, n.source_size, n.target,
       (d.size * (n.copies + CASE WHEN e.place IS NULL THEN 0 WHEN d.place < e.place THEN 1
                                  WHEN d.place = e.place AND e.rest * 2 >= e.words THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN needs n ON d.source IS NOT DISTINCT FROM n.source
LEFT JOIN ends e ON d.source IS NOT DISTINCT FROM e.source
"""
