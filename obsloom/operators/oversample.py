"""Even out classes: more rows for the small ones, or more weight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from obsloom.operators.neighbours import as_vector, nearest_neighbours
from obsloom.operators.ranks import cuts_passed, seeded_hash
from obsloom.operators.sizes import measured

CHUNK = 1000


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``label, n, weight`` with weight n / (classes * rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n").alias("__all"), F.count("*").alias("__classes")).first()
    share = F.lit(whole["__all"]) / (F.lit(whole["__classes"]) * F.col("n"))
    return counts.withColumn("weight", share)


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(measured(weights), label)


def _fraction(*parts) -> object:
    """A reproducible number in [0, 1) from a hash of the parts."""
    digest = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.conv(digest, 16, 10).cast("double") / F.lit(float(2**32))


def oversample(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    key: Sequence[str],
    k: int = 3,
    seed: int = 42,
    **search: int,
) -> DataFrame:
    """Rows ``label, features, synthetic`` with all classes as large as the largest.

    Each new row lies between a row and one of its k nearest neighbours of the same class. A class that
    needs m new rows for n rows gives each row m // n of them and one more to the first m % n rows in
    seeded order. A class with one row repeats it. Rows that lack a feature or the label are left out.
    """
    columns = list(features)
    spread_out = [F.col("x")[i].alias(c) for i, c in enumerate(columns)]
    complete = df.select(label, *[c for c in key if c != label], as_vector(columns).alias("x"))
    complete = complete.where(F.col(label).isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    counts = {r[label]: r["n"] for r in complete.groupBy(label).agg(F.count("*").alias("n")).collect()}
    target = max(counts.values())
    real = complete.select(label, *spread_out, F.lit(False).alias("synthetic"))
    short = {c: target - n for c, n in counts.items() if n < target}
    if not short:
        return real

    minority = complete.where(F.col(label).isin(list(short)))
    every, extra = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for c, missing in short.items():
        here = F.col(label) == F.lit(c)
        every = F.when(here, F.lit(missing // counts[c]).cast("bigint")).otherwise(every)
        extra = F.when(here, F.lit(missing % counts[c]).cast("bigint")).otherwise(extra)
    marked = cuts_passed(minority, [label], key, seed, F.array(extra), "__passed")
    first = (F.col("__passed") == 0) & (extra > 0)
    marked = marked.withColumn("__times", every + F.when(first, 1).otherwise(0)).where(F.col("__times") > 0)

    near = nearest_neighbours(minority, label, "x", k, **search)
    near = near.select(F.col(label).alias("__label"), "x", "neighbours")
    parents = marked.withColumn("__label", F.col(label).cast("string")).join(near, ["__label", "x"])

    # one row of a tiny class may have very many children: spread them before they are made
    chunks = F.sequence(F.lit(0), F.floor((F.col("__times") - 1) / CHUNK))
    parents = parents.withColumn("__chunk", F.explode(chunks))
    if max(missing // counts[c] for c, missing in short.items()) >= CHUNK:
        parents = parents.repartition(F.xxhash64(*key), F.col("__chunk"))
    last = F.least(F.col("__times"), (F.col("__chunk") + 1) * CHUNK) - 1
    children = parents.withColumn("__child", F.explode(F.sequence(F.col("__chunk") * CHUNK, last)))
    hashed = [seeded_hash(key, seed), F.col("__child").cast("string")]
    choice = F.floor(_fraction(*hashed, F.lit("neighbour")) * F.size("neighbours")).cast("int")
    chosen = F.when(F.size("neighbours") > 0, F.get("neighbours", choice)).otherwise(F.col("x"))
    made = children.select(label, "x", chosen.alias("__near"), _fraction(*hashed, F.lit("step")).alias("__step"))
    between = F.zip_with("x", "__near", lambda a, b: a + F.col("__step") * (b - a))
    made = made.select(label, between.alias("x"))
    return real.unionByName(made.select(label, *spread_out, F.lit(True).alias("synthetic")))
