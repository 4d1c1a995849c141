"""Mixing sources to target weights by Poisson replication.

Each source's mean repetition rate is its target share of the output over its
share of the input.  A document's count is a Poisson draw with that mean: a
uniform number hashed from the seed and the doc_id, put through the inverse of
the distribution function.  The document is exploded by its count and the
copies are shuffled globally by a hash.  Everything is a function of the rows
and the seed, so a lost task comes back the same.

Means over ``STEP`` are drawn as a sum of independent Poisson numbers of at
most that mean each, so exp(-mean) never underflows.  A document of more than
``BLOCK_DRAWS`` of them (of a tiny source) is drawn and exploded in blocks of so
many, dealt over the tasks, so no row holds all its copies.

Defined results: a source without a target weight gets ``other_weight``; NULL
is a source of its own; a source of weight zero yields nothing; sources of no
size (no characters) have rate zero; rows repeated in the input draw the same
count; a NULL doc_id draws as the text 'null'.  Columns of the input pass
through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebasket.llm.common import numbered, table, written

#: Largest mean drawn at once.
STEP = 16.0
#: Entries of the distribution function kept for a mean of at most STEP: the rest has probability under 1e-16.
TERMS = 80
#: Draws of a document that one row counts and explodes: about STEP times as many copies at most.
BLOCK_DRAWS = 1024
#: Up to so many sources (under 1 kB each) their rates are broadcast.
BROADCAST_SOURCES = 10_000
SEED = 20240601
#: The production mixture: one dominant source held to a tenth, the others even.
WEIGHTS = {"src0": 2.0}


def uniform(seed: int, key: Column, draw: Column) -> Column:
    """52 bits of MD5 as a number in [0, 1)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"),
                            draw.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str, float], other_weight: float = 1.0, epochs: float = 1.0,
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, size, mean, cdf): one row a source.  Sizes are characters; with
    ``epochs`` 1 the output has as many as the input.  ``cdf`` is the
    distribution function of one of the ``draws`` equal parts of ``mean``."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("size"))
    weight = F.lit(other_weight)
    for name, w in weights.items():
        weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    sizes = written(sizes, "mix-sizes").withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    total = sizes.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight")).first()
    size, weights_sum = float(total["all_size"] or 0), float(total["all_weight"] or 0)
    if not size or not weights_sum:
        mean = F.lit(0.0)
    else:
        mean = F.when(F.col("size") > 0, F.lit(epochs * size / weights_sum) * F.col("weight") / F.col("size")).otherwise(0.0)
    part = F.col("mean") / F.col("draws")
    term = F.struct(F.exp(-part).alias("p"), F.array(F.exp(-part)).alias("sums"))
    cdf = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)), term,
        lambda acc, k: F.struct(
            (acc["p"] * part / k).alias("p"),
            F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + acc["p"] * part / k)).alias("sums")),
        lambda acc: acc["sums"])
    return (sizes.withColumn("mean", mean).withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("mean") / STEP)))
            .withColumn("cdf", cdf).select("source", "size", "mean", "draws", "cdf"))


def _drawn(seed: int, key: Column, first: Column, last: Column) -> Column:
    """The sum of a document's draws from ``first`` to ``last``."""
    return F.aggregate(
        F.sequence(first.cast("long"), last.cast("long")), F.lit(0).cast("long"),
        lambda acc, d: acc + F.size(F.filter(F.col("cdf"), lambda p: p <= uniform(seed, key, d))))


def _rated(rows: DataFrame, rate: DataFrame, few: bool, source: Column) -> DataFrame:
    # more sources than may be broadcast: a join split by AQE at its hot ones
    return rows.join(F.broadcast(rate) if few else rate, source.eqNullSafe(F.col("source")))


def _ranges(rows: DataFrame, rate: DataFrame, few: bool, seed: int, key: Column, source: Column) -> DataFrame:
    """``rows`` with ``start`` and ``copies``: the numbers of all copies of a row."""
    out = _rated(rows, rate, few, source).withColumn("copies", _drawn(seed, key, F.lit(1), F.col("draws")))
    return out.where("copies > 0").select(*rows.columns, F.lit(0).cast("long").alias("start"), "copies")


def _block_ranges(rows: DataFrame, rate: DataFrame, few: bool, seed: int, key: Column, source: Column) -> DataFrame:
    """The same, a row for each ``BLOCK_DRAWS`` draws of a row, dealt by block."""
    rated = written(_rated(rows, rate, few, source), "mix-many")
    blocks = rated.select(key.alias("of_key"), "source", "draws").distinct().withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("draws") - 1) / BLOCK_DRAWS))))
    blocks = _rated(blocks.repartition("of_key", "block").withColumnRenamed("source", "of_source").drop("draws"),
                    rate, few, F.col("of_source"))
    first = F.col("block") * BLOCK_DRAWS
    drawn = blocks.select("of_key", "of_source", "block", _drawn(
        seed, F.col("of_key"), first + 1, F.least(first + BLOCK_DRAWS, F.col("draws"))).alias("copies"))
    before = Window.partitionBy("of_key", "of_source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = written(drawn.withColumn("start", F.coalesce(F.sum("copies").over(before), F.lit(0).cast("long"))), "mix-blocks")
    out = rated.select(*rows.columns).join(placed.where("copies > 0"), key.eqNullSafe(F.col("of_key")) & source.eqNullSafe(F.col("of_source")))
    return out.repartition("of_key", "block").select(*rows.columns, "start", "copies")


def mix(docs: DataFrame, weights: dict[str, float], other_weight: float = 1.0, epochs: float = 1.0, seed: int = SEED,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        copy_col: str | None = None) -> DataFrame:
    """``docs`` replicated to the target weights, in globally shuffled order;
    with ``copy_col`` the copy's number from 0 as one more column."""
    names = docs.columns
    rate = rates(docs, weights, other_weight, epochs, source_col, text_col)
    found = rate.agg(F.count("*").alias("n"), F.max("draws").alias("draws")).first()
    few = found["n"] <= BROADCAST_SOURCES
    rate = rate.select("source", "draws", "cdf")
    rows = numbered(docs)
    key, source = (F.col(f"c{names.index(c)}") for c in (id_col, source_col))
    ranges = _ranges(rows, rate.where(F.col("draws") <= BLOCK_DRAWS), few, seed, key, source)
    if (found["draws"] or 0) > BLOCK_DRAWS:
        ranges = ranges.unionByName(_block_ranges(rows, rate.where(F.col("draws") > BLOCK_DRAWS), few, seed, key, source))
    copies = ranges.withColumn("copy", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("copies") - 1)))
    copies = copies.withColumn("place", F.xxhash64(F.lit(seed), key, F.col("copy")))
    # hash partitions of a random key in the key's order: a random permutation cut into files
    out = copies.repartition("place").sortWithinPartitions("place", key)
    kept = out.select(*rows.columns, *(["copy"] if copy_col else []))
    return kept.toDF(*names, *([copy_col] if copy_col else []))


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, WEIGHTS, copy_col="copy").select("doc_id", "source", "copy", "text")


ORACLE_OP1 = f"""
WITH RECURSIVE sizes AS (
  SELECT source, coalesce(sum(length(text)), 0) AS size,
         CASE WHEN coalesce(sum(length(text)), 0) = 0 THEN 0.0 WHEN source = 'src0' THEN 2.0 ELSE 1.0 END AS weight
  FROM documents GROUP BY source
), means AS (
  SELECT source, CASE WHEN size = 0 THEN 0.0 ELSE
    CAST((SELECT sum(size) FROM sizes) AS DOUBLE) / (SELECT sum(weight) FROM sizes) * weight / size END AS mean FROM sizes
), parts AS (
  SELECT source, greatest(1, CAST(ceil(mean / {STEP}) AS BIGINT)) AS draws,
         mean / greatest(1, CAST(ceil(mean / {STEP}) AS BIGINT)) AS part FROM means
), cdf(source, draws, part, k, p, total) AS (
  SELECT source, draws, part, 0, exp(-part), exp(-part) FROM parts
  UNION ALL
  SELECT source, draws, part, k + 1, p * part / (k + 1), total + p * part / (k + 1) FROM cdf WHERE k < {TERMS}
), drawn AS (
  SELECT doc_id, source, text, draw,
         CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' ||
                                  CAST(draw AS VARCHAR)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents JOIN (SELECT source AS s, unnest(generate_series(1, draws)) AS draw FROM parts)
    ON source IS NOT DISTINCT FROM s
), counts AS (
  SELECT doc_id, d.source, any_value(text) AS text, count(*) AS copies
  FROM drawn d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND c.total <= d.u GROUP BY doc_id, d.source
)
SELECT doc_id, source, CAST(unnest(generate_series(0, copies - 1)) AS BIGINT) AS copy, text FROM counts
"""
