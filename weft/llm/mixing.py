"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UID, reserve, salt

# Poisson means above this are split into a sum of smaller ones, so that each table of probabilities stays short.
MEAN = 16.0
# With a mean of at most 16, the chance of 100 or more is below the 2**-52 steps of the uniform numbers.
TERMS = 100
# Up to this many sources the table of rates (under 10 MB) is broadcast; more are joined on (source, salt).
BROADCAST_SOURCES = 10_000
SALTS = 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of the parts, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def _cumulative(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson distribution."""
    zero = F.exp(-mean)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(zero.alias("p"), zero.alias("c"), F.array(zero).alias("all")),
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            (acc["c"] + acc["p"] * mean / k).alias("c"),
            F.concat(acc["all"], F.array(acc["c"] + acc["p"] * mean / k)).alias("all"),
        ),
        lambda acc: acc["all"],
    )


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, ratio: float = 1.0, source: str = "source") -> DataFrame:
    """(source, n_rows, rate): the mean number of copies that brings each source to its weight.

    ``weights`` gives shares of the output; what they leave of 1 is divided
    equally among the sources not named (a null source is one of them). Named
    sources without rows are left out and the shares of the others scaled up.
    The output has ``ratio`` times the rows of the input, in the mean.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    named = dict(weights or {})
    rest = max(0.0, 1.0 - sum(named.values()))
    pairs = [F.lit(x) for kv in named.items() for x in kv]
    share = F.element_at(F.create_map(*pairs), F.col("source")) if pairs else F.lit(None).cast("double")
    counts = counts.withColumn("named", share)
    total = counts.agg(
        F.sum("n_rows").alias("all_rows"), F.count_if(F.col("named").isNull()).alias("others"),
        F.coalesce(F.sum("named"), F.lit(0.0)).alias("given"),
    )
    weight = F.coalesce(F.col("named"), F.lit(rest) / F.col("others"))
    whole = F.col("given") + F.when(F.col("others") > 0, F.lit(rest)).otherwise(0.0)
    # one row of totals
    return counts.join(F.broadcast(total)).select(
        "source", "n_rows", (F.lit(float(ratio)) * F.col("all_rows") * (weight / whole) / F.col("n_rows")).alias("rate")
    )


def replicate(docs: DataFrame, weights: Mapping[str, float] | None = None, ratio: float = 1.0, seed: int = 42,
              source: str = "source", key: str = "doc_id") -> DataFrame:
    """Rows of ``docs``, each as often as a Poisson draw with its source's rate says, in a random global order.

    Adds weft_rate, weft_copies, weft_copy (from 0) and weft_order, by which
    rows are dealt over partitions and sorted within them. The draw inverts the
    Poisson distribution at a hash of (seed, key), so it is the same on every
    run and on any cluster; repeated rows with the same key draw alike, a null
    key draws as the text 'null'. Means above 16 are drawn as sums of
    independent ones. Nothing is capped.

    A row is multiplied before it is shuffled once, by its random order, so no
    source or group of copies stays together. Rates reach the rows by broadcast
    while their number is at most ``BROADCAST_SOURCES``, otherwise by a join on
    (source, salt). An empty table gives no rows; texts are carried, not read, so their
    length does not matter. Columns with names that are added or needed inside (weft_...) are refused.
    """
    reserve(docs, UID, *(f"weft_{x}" for x in ("source", "rate", "slices", "cdf", "copies", "copy", "order", "salt", "salt2")))
    found = rates(docs, weights, ratio, source).select(
        F.col("source").alias("weft_source"), F.col("rate").alias("weft_rate"),
        F.greatest(F.lit(1), F.ceil(F.col("rate") / MEAN)).cast("int").alias("weft_slices"),
    ).withColumn("weft_cdf", _cumulative(F.col("weft_rate") / F.col("weft_slices")))
    few = found.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    same = F.col(source).eqNullSafe(F.col("weft_source"))
    if few:
        rated = docs.join(F.broadcast(found), same)
    else:
        rows = docs.withColumn(UID, F.monotonically_increasing_id()).withColumn("weft_salt", salt(UID, SALTS))
        dealt = found.withColumn("weft_salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rated = rows.join(dealt, same & (F.col("weft_salt") == F.col("weft_salt2"))).drop(UID, "weft_salt", "weft_salt2")
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    draws = F.transform(
        F.sequence(F.lit(0), F.col("weft_slices") - 1),
        lambda j: F.size(F.filter(F.col("weft_cdf"), lambda c: c <= uniform(F.lit(seed), name, j))),
    )
    copies = F.aggregate(draws, F.lit(0), lambda a, b: a + b)
    out = (
        rated.withColumn("weft_copies", copies).where("weft_copies > 0").drop("weft_source", "weft_slices", "weft_cdf")
        .withColumn("weft_copy", F.explode(F.sequence(F.lit(0), F.col("weft_copies") - 1)))
        .withColumn("weft_order", F.xxhash64(F.lit(seed), name, F.col("weft_copy")))
    )
    return out.repartition(F.col("weft_order")).sortWithinPartitions("weft_order", key, "weft_copy")
