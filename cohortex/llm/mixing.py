"""Mix sources to target weights: random keys, ranges within a source, prefix sums, exact cut.

Every row gets a hash-random key (MD5 of seed, id and the text's MD5). A source's rows are ordered by that
key and dealt into ``ranges`` equal key ranges; because the keys are uniform the ranges of
the largest source are even, so a source with a third of all rows is spread over all of
them, also where ids are null or repeat. Range sums give the words before each range (one small row per source and range), a
running sum inside each range does the rest. The source's budget is cut exactly: whole
epochs first, then the rows in key order up to the budget; the row on the cut gives its
leading words only, so a source takes exactly floor(target) words.

Targets: the mix takes ``share`` times all words, dealt by weight; a source stops at
``max_epochs`` times its size and its excess is dealt again by weight. The fixed point is
read off one ordering of the sources by size / weight, without iteration.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; rows that tie on key, id, size and text are interchangeable. A source without words
has target 0. An empty table gives an empty result. ``mix`` keeps every column of the input,
whatever its name; ``plan`` adds columns that start with ``_mix`` and needs these names free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortex.llm.common import WORD, durable, positional, table, text_of, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
ROWS_PER_RANGE = 250_000
LEAST_RANGES = 64


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``_mix_source, _mix_source_size`` -> plus ``_mix_target``; one row per source."""
    by_name = Window.orderBy(F.col("_mix_source").asc_nulls_last())
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("_weight", weight).withColumn("_cap", F.col("_mix_source_size") * float(max_epochs))
    capped = capped.withColumn("_level", F.col("_cap") / F.col("_weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("_level", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("_mix_source_size").over(everything) * float(share) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    )
    filled = capped.withColumn("_fill", level)
    # the first source in order of cap / weight that the common level does not overfill
    water = F.min(F.when(F.col("_fill") <= F.col("_level"), F.struct("_level", "_rank", "_fill"))).over(everything)
    return filled.withColumn("_water", water["_fill"]).select(
        "_mix_source",
        "_mix_source_size",
        F.when(F.col("_water").isNull(), F.col("_cap"))
        .otherwise(F.least("_cap", F.col("_water") * F.col("_weight")))
        .alias("_mix_target"),
    )


def plan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Every row of ``df`` plus _mix_size, _mix_source_size, _mix_target, _mix_epochs, _mix_part.

    ``_mix_epochs`` whole copies and, of one more copy, the first ``_mix_part`` words.
    """
    return _placed(keyed(df, id_col, text_col, source_col, seed), id_col, weights, share, max_epochs)


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """``df`` plus each row's size, key, tie and source: all that the plan needs of a text."""
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    key = F.md5(F.concat(F.lit(seed + ":"), id_text, F.lit(":"), F.md5(text_of(text_col).cast("binary"))))
    return df.withColumns(
        {"_mix_size": word_count(text_col), "_mix_key": key, "_mix_tie": F.xxhash64(text_of(text_col)), "_mix_source": F.col(source_col).cast("string")}
    )


def _placed(df: DataFrame, id_col: str, weights: tuple = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The plan of rows that are ``keyed``."""
    ranges = max(LEAST_RANGES, -(-df.count() // ROWS_PER_RANGE))
    place = F.conv(F.substring("_mix_key", 1, 8), 16, 10).cast("long")
    rows = df.withColumn("_mix_range", F.floor(place * ranges / F.lit(2**32)).cast("long"))
    sums = rows.groupBy("_mix_source", "_mix_range").agg(F.sum("_mix_size").alias("_mix_sum"))
    goals = targets(sums.groupBy("_mix_source").agg(F.sum("_mix_sum").alias("_mix_source_size")), weights, share, max_epochs)
    earlier = Window.partitionBy("_mix_source").orderBy("_mix_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_mix_offset", F.coalesce(F.sum("_mix_sum").over(earlier), F.lit(0)))
    g = goals.withColumnRenamed("_mix_source", "_goal_source")
    offsets = offsets.join(g, F.col("_mix_source").eqNullSafe(F.col("_goal_source"))).select(
        F.col("_mix_source").alias("_mix_o_source"),
        F.col("_mix_range").alias("_mix_o_range"),
        "_mix_offset",
        "_mix_source_size",
        "_mix_target",
    )
    placed = rows.join(
        offsets, F.col("_mix_source").eqNullSafe(F.col("_mix_o_source")) & (F.col("_mix_range") == F.col("_mix_o_range"))
    )
    inside = (
        Window.partitionBy("_mix_source", "_mix_range")
        .orderBy("_mix_key", id_col, "_mix_size", "_mix_tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("_mix_offset") + F.coalesce(F.sum("_mix_size").over(inside), F.lit(0))
    budget, total = F.floor("_mix_target").cast("long"), F.col("_mix_source_size")
    epochs = F.when(total > 0, F.floor(budget / total)).otherwise(0).cast("long")
    rest = F.when(total > 0, budget % total).otherwise(0).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("_mix_size"), rest - F.col("_mix_start")))
    return (
        placed.withColumn("_mix_start", start)
        .withColumns({"_mix_epochs": epochs, "_mix_part": part.cast("long")})
        .drop("_mix_key", "_mix_range", "_mix_tie", "_mix_source", "_mix_o_source", "_mix_o_range", "_mix_offset", "_mix_start")
    )


def _leading_words(column: str, n: Column) -> Column:
    """The text up to the end of its n-th word, unchanged before that."""
    pieces = F.regexp_extract_all(text_of(column), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed rows: each row of ``df`` as often as the plan says, the last one cut to its words.

    A text without words adds nothing to any budget; it is kept once.
    """
    rows, name = positional(df)
    planned = plan(rows, name[id_col], name[text_col], name[source_col], **options)
    whole = planned.withColumn("_mix_words", F.array_repeat(F.col("_mix_size"), F.col("_mix_epochs").cast("int")))
    copies = whole.withColumn(
        "_mix_words",
        F.when(F.col("_mix_size") == 0, F.array(F.lit(0).cast("long")))
        .when(F.col("_mix_part") > 0, F.concat("_mix_words", F.array("_mix_part")))
        .otherwise(F.col("_mix_words")),
    ).withColumn("_mix_words", F.explode("_mix_words"))
    text = name[text_col]
    cut = F.when(F.col("_mix_words") < F.col("_mix_size"), _leading_words(text, F.col("_mix_words"))).otherwise(F.col(text))
    return copies.withColumn(text, cut).select(*rows.columns).toDF(*df.columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    # texts are read once; the plan passes over their slim rows
    return _placed(durable(keyed(docs).drop("text"), "mix_rows"), "doc_id").select(
        "doc_id",
        F.col("_mix_size").alias("size"),
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_epochs") * F.col("_mix_size") + F.col("_mix_part")).alias("taken"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1 AS i
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE i % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap FROM s
), f AS (
  SELECT *, cap / weight AS lvl,
         ((SELECT sum(source_size) FROM w) * 1.5::DOUBLE
           - coalesce(sum(cap) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / ((SELECT sum(weight) FROM w)
           - coalesce(sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS fill
  FROM w
), t AS (
  SELECT source, source_size,
         coalesce(least(cap, weight * (SELECT fill FROM f WHERE fill <= lvl ORDER BY lvl, i LIMIT 1)), cap) AS target
  FROM f
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE
         (floor(target)::BIGINT // source_size) * size
         + greatest(0, least(size, floor(target)::BIGINT % source_size - before)) END::BIGINT AS taken
FROM p
"""
