"""Mixing sources to target weights by Poisson replication.

Source s with size n_s (characters) and target weight w_s gets the mean
repetition rate  r_s = w_s * budget / n_s.  Each document draws its number of
copies by inverting the Poisson distribution with that mean at a hash of its
id, so the draw is repeatable anywhere; the copies are exploded and shuffled
globally by another hash.

A rate above ``MAX_PART`` is drawn as a sum of Poisson draws of equal smaller
means, which has the same distribution and does not underflow.

Defined results: a null source is a source of its own; null texts count as
size 0, and a source of size 0 gets rate 0; documents with equal ids get equal
draws, a null id is replaced by a hash of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlab.session import checkpoint

MAX_PART = 100.0
MAX_SOURCES = 10_000  # rate rows that are broadcast; beyond, the join shuffles


def source_rates(
    docs: DataFrame,
    weights: DataFrame | None = None,
    temperature: float = 0.7,
    epochs: float = 1.0,
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``source, size, rate, part_rate, parts, cdf``.  ``weights`` (source,
    weight) gives target weights of any scale (sources missing from it get 0);
    by default a source's weight is its size to the power ``temperature``.
    ``epochs`` is the mean size of the mix as a multiple of the input."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.coalesce(F.sum(F.length(F.col(text_col).cast("string"))), F.lit(0)).alias("size")
    )
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow("size", F.lit(temperature)))
    else:
        w = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double").alias("weight"))
        weighted = sizes.join(w, sizes["source"].eqNullSafe(w["w_source"]), "left").drop("w_source")
        weighted = weighted.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    weighted = checkpoint(weighted)  # one row per source
    all_size, all_weight = weighted.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.when(
        (F.col("size") > 0) & F.lit(bool(all_weight)),
        F.col("weight") / F.lit(all_weight or 1.0) * F.lit(float(epochs)) * F.lit(float(all_size or 0)) / F.col("size"),
    ).otherwise(0.0)
    rated = weighted.select("source", "size", rate.alias("rate"))
    rated = rated.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_PART)).cast("int"))
    rated = rated.withColumn("part_rate", F.col("rate") / F.col("parts"))
    start = F.struct(
        F.exp(-F.col("part_rate")).alias("term"),
        F.exp(-F.col("part_rate")).alias("total"),
        F.array(F.exp(-F.col("part_rate"))).alias("cdf"),
    )

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * F.col("part_rate") / k
        total = acc["total"] + term
        return F.struct(term.alias("term"), total.alias("total"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    # Beyond so many terms the tail is below the resolution of the draws.
    terms = F.ceil(F.col("part_rate") + 12 * F.sqrt("part_rate") + 30).cast("int")
    return rated.withColumn("cdf", F.aggregate(F.sequence(F.lit(1), terms), start, step)["cdf"])


def uniform(*key: Column) -> Column:
    """Number in [0, 1) from the first 52 bits of the SHA-256 of the key."""
    digits = F.substring(F.sha2(F.concat_ws(":", *key), 256), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 52)


def replicate(
    docs: DataFrame,
    rates: DataFrame,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The mix: all columns of ``docs`` plus ``copy`` (1..n_copies),
    ``n_copies`` and ``shuffle_key``, dealt over partitions and ordered within
    them by ``shuffle_key``.  Clashing columns of ``docs`` are replaced."""
    own = docs.drop("copy", "n_copies", "shuffle_key")
    name = "__key"
    while name in own.columns:
        name += "_"
    key = F.coalesce(
        F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    )
    r = rates.select(
        F.col("source").alias(f"{name}_source"), F.col("parts").alias(f"{name}_parts"), F.col("cdf").alias(f"{name}_cdf")
    )
    if rates.count() <= MAX_SOURCES:  # a row of about a kilobyte per source
        r = F.broadcast(r)
    joined = own.withColumn(name, key).join(r, F.col(source_col).eqNullSafe(F.col(f"{name}_source")))

    def draw(total: Column, part: Column) -> Column:
        u = uniform(F.lit(f"copies:{seed}"), part.cast("string"), F.col(name))
        return total + F.size(F.filter(F.col(f"{name}_cdf"), lambda c: c <= u))

    n = F.aggregate(F.sequence(F.lit(1), F.col(f"{name}_parts")), F.lit(0), draw)
    copies = joined.withColumn("n_copies", n).filter("n_copies > 0")
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    copies = copies.withColumn(
        "shuffle_key",
        F.substring(F.sha2(F.concat_ws(":", F.lit(f"shuffle:{seed}"), F.col("copy").cast("string"), F.col(name)), 256), 1, 16),
    )
    return (
        copies.select(*own.columns, "copy", "n_copies", "shuffle_key")
        .repartition("shuffle_key", "copy")
        .sortWithinPartitions("shuffle_key")
    )
