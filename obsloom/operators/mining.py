"""Frequent itemsets and association rules, per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from obsloom.functions.arrays import any_in, short_label
from obsloom.session import checkpointed


def _by_group(group: str, values: Mapping[str, float], default: float) -> Column:
    """The group's value; groups that are not named, and NULL, have the default."""
    chosen = F.lit(float(default))
    for name, value in values.items():
        chosen = F.when(F.col(group) == name, F.lit(float(value))).otherwise(chosen)
    return chosen


def itemsets(
    df: DataFrame, items: str, group: str, min_support: Mapping[str, float], default: float, max_size: int | None = None
) -> DataFrame:
    """``group, items, freq, n_baskets`` for every itemset that reaches its group's support.

    Equal baskets are counted first, so the work depends on the distinct ones; all groups are mined at
    once. Size by size, a basket's frequent sets grow by its later items that are frequent themselves, and
    only sets that are frequent grow further, so baskets may have any length. Items must be distinct
    and not NULL.
    """
    baskets = df.groupBy(F.col(group), F.sort_array(items).alias("__basket")).agg(F.count("*").alias("__n"))
    baskets = checkpointed(baskets.where(F.size("__basket") > 0).withColumn("__id", F.monotonically_increasing_id()))
    totals = baskets.groupBy(group).agg(F.sum("__n").alias("n_baskets"))
    needed = totals.select(
        F.struct(group).alias("__g"), "n_baskets", F.ceil(_by_group(group, min_support, default) * F.col("n_baskets")).alias("__needed")
    )

    def frequent(sets: DataFrame) -> DataFrame:
        counted = sets.groupBy("__g", "items").agg(F.sum("__n").alias("freq"))
        return checkpointed(counted.join(needed, "__g").where(F.col("freq") >= F.col("__needed")).drop("__needed"))

    single = baskets.select(F.struct(group).alias("__g"), "__id", "__n", F.explode("__basket").alias("item"))
    found = frequent(single.withColumn("items", F.array("item")))
    listed = single.join(found.select("__g", F.col("items")[0].alias("item")), ["__g", "item"])
    # what is left of a basket: its frequent items in order
    left = listed.groupBy("__g", "__id", "__n").agg(F.sort_array(F.collect_list("item")).alias("rest"))
    sets = checkpointed(left.select("__g", "__id", "__n", "rest", F.posexplode("rest").alias("last", "item")).select(
        "__g", "__id", "__n", "rest", "last", F.array("item").alias("items")
    ))
    every, size = found, 1
    while not found.isEmpty() and (max_size is None or size < max_size):
        size += 1
        later = F.sequence(F.col("last") + 1, F.size("rest") - 1)
        grown = sets.where(F.col("last") + 1 < F.size("rest")).select("__g", "__id", "__n", "rest", "items", F.explode(later).alias("last"))
        grown = grown.withColumn("items", F.array_append("items", F.get("rest", F.col("last"))))
        found = frequent(grown)
        sets = checkpointed(grown.join(found.select("__g", "items"), ["__g", "items"], "left_semi"))
        every = every.unionByName(found)
    return every.select(F.col(f"__g.{group}").alias(group), "items", "freq", "n_baskets")


def rules(found: DataFrame, group: str, min_confidence: Mapping[str, float], default: float) -> DataFrame:
    """``group, antecedent, consequent, support, confidence, lift`` with one item on the right."""
    whole = found.where(F.size("items") > 1).select(
        group, "freq", "n_baskets", "items", F.explode("items").alias("__right")
    )
    whole = whole.select(
        group,
        "freq",
        "n_baskets",
        F.array_remove("items", F.col("__right")).alias("antecedent"),
        F.array("__right").alias("consequent"),
    )
    left = found.select(group, F.col("items").alias("antecedent"), F.col("freq").alias("__left_freq"))
    right = found.where(F.size("items") == 1).select(
        group, F.col("items").alias("consequent"), F.col("freq").alias("__right_freq")
    )
    confidence = F.col("freq") / F.col("__left_freq")
    return (
        whole.join(left, [group, "antecedent"])
        .join(right, [group, "consequent"])
        .select(
            group,
            "antecedent",
            "consequent",
            (F.col("freq") / F.col("n_baskets")).alias("support"),
            confidence.alias("confidence"),
            (confidence / (F.col("__right_freq") / F.col("n_baskets"))).alias("lift"),
        )
        .where(F.col("confidence") >= _by_group(group, min_confidence, default))
    )


def fp_growth(
    df: DataFrame, items: str, min_support: float, min_confidence: float, partitions: int | None = None
) -> FPGrowthModel:
    """Spark's FP-growth, for baskets of any length; empty baskets do not count."""
    miner = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence)
    if partitions:
        miner = miner.setNumPartitions(partitions)
    return miner.fit(df.select(items).where(F.size(items) > 0))


def fp_growth_rules(
    df: DataFrame,
    items: str,
    group: str,
    min_support: Mapping[str, float],
    min_confidence: Mapping[str, float],
    default_support: float,
    default_confidence: float,
    partitions: int | None = None,
) -> DataFrame:
    """One FP-growth fit per group, the rules in the layout of :func:`rules`; for a handful of groups."""
    united = None
    for name in sorted(r[0] for r in df.select(group).where(F.col(group).isNotNull()).distinct().collect()):
        support, confidence = min_support.get(name, default_support), min_confidence.get(name, default_confidence)
        model = fp_growth(df.where(F.col(group) == name), items, support, confidence, partitions)
        found = model.associationRules.select(
            F.lit(name).alias(group),
            F.sort_array("antecedent").alias("antecedent"),
            F.sort_array("consequent").alias("consequent"),
            "support",
            "confidence",
            "lift",
        )
        united = found if united is None else united.unionByName(found)
    return united


def rules_for(found: DataFrame, targets: Sequence[str], min_lift: float | None = None) -> DataFrame:
    """Rules that lead to one of the targets, optionally with a least lift."""
    kept = found.where(any_in(F.col("consequent"), targets))
    return kept if min_lift is None else kept.where(F.col("lift") >= min_lift)


def top_rules(found: DataFrame, group: str, n: int, out: str = "place") -> DataFrame:
    """The ``n`` rules of each group with the highest lift; ties by confidence, then by items."""
    strongest = W.partitionBy(group).orderBy(
        F.desc(F.round("lift", 9)), F.desc(F.round("confidence", 9)), "antecedent", "consequent"
    )
    return found.withColumn(out, F.row_number().over(strongest)).where(F.col(out) <= n)


def top_itemsets(found: DataFrame, group: str, n: int, out: str = "place") -> DataFrame:
    most = W.partitionBy(group).orderBy(F.desc("freq"), "items")
    return found.withColumn(out, F.row_number().over(most)).where(F.col(out) <= n)


def item_confidence(found: DataFrame, group: str, groups: Sequence[str]) -> DataFrame:
    """``item, group, confidence``: mean confidence of rules with the item on the left, 0 if none."""
    means = [
        F.coalesce(F.avg(F.when(F.col(group) == g, F.col("confidence"))), F.lit(0.0)).alias(f"__{i}")
        for i, g in enumerate(groups)
    ]
    entries = [F.struct(F.lit(g).alias(group), F.col(f"__{i}").alias("confidence")) for i, g in enumerate(groups)]
    listed = found.where(F.col(group).isin(list(groups)))
    per_item = listed.select(group, "confidence", F.explode("antecedent").alias("item")).groupBy("item").agg(*means)
    return per_item.select("item", F.inline(F.array(*entries)))


def rule_edges(found: DataFrame, group: str, keep: int = 3) -> DataFrame:
    """``group, source, target, weight, confidence``: one edge per rule and item on the right."""
    return found.select(
        group,
        short_label(F.col("antecedent"), keep).alias("source"),
        F.explode("consequent").alias("target"),
        F.col("lift").alias("weight"),
        "confidence",
    )
