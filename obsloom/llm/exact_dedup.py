"""Exact duplicates by a content sort.

Sampled splitters cut the order of the normalised texts into ranges, each range is sorted (Spark's sort
spills to disk), equal texts then lie side by side, and a row belongs to the run of its neighbour when the
whole texts are equal. A text with many copies spans several ranges, because ties are cut by identifier;
its runs are put together again from the first run and the last run of each range, which are the only ones
that can go on elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsloom.llm.texts import SPACE, Sealed, pick, shuffle_partitions, whole_text
from obsloom.session import checkpointed

#: Code points of a text that a splitter holds.
LEAD = 48
#: Sampled rows for each range.
SAMPLE = 8
#: Ranges for each shuffle partition; more than one, so that partitions come out even.
SPREAD = 4
NO_ID = 2**63 - 1


def normalised(text: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(text, SPACE, " ")


def sort_key() -> Column:
    """Leading characters, a hash of the whole text, the identifier (nulls last): the order that is cut."""
    return F.struct(
        F.substring("norm", 1, LEAD).alias("lead"),
        F.xxhash64("norm").alias("mark"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
    )


def splitters(rows: DataFrame, ranges: int) -> list:
    """Cut points: every ``SAMPLE``-th key of a hash-chosen sample of about ``ranges * SAMPLE`` rows.

    They only say where a range ends; which rows are equal never depends on them.
    """
    wanted = ranges * SAMPLE
    share = min(1.0, wanted / max(1, rows.count()))
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    sample = rows.filter(chosen).limit(2 * wanted)
    keys = sample.select(normalised(F.col("text")).alias("norm"), "doc_id").select(sort_key().alias("key"))
    return [r["key"] for r in keys.orderBy("key").collect()][SAMPLE::SAMPLE]


def range_of(cuts: list) -> Column:
    """Number of a row's range, the count of cuts that are not above ``key``, by bisection."""
    if not cuts:
        return F.lit(0)
    table = F.array(*[
        F.struct(F.lit(c["lead"]).alias("lead"), F.lit(c["mark"]).alias("mark"), F.lit(c["id"]).alias("id")) for c in cuts
    ])

    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        is_open = span["low"] < span["high"]
        above = F.get(table, middle) <= F.col("key")
        return F.struct(
            F.when(is_open & above, middle + 1).otherwise(span["low"]).alias("low"),
            F.when(is_open & ~above, middle).otherwise(span["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
    start = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))
    return F.aggregate(steps, start, halve, lambda span: span["low"])


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): which row of its group of equal texts stays.

    Returns doc_id, keep_id (identifier of the row that stays), group_size, kept, text_sha256 (of the
    normalised text). Null texts count as empty, and empty texts form one group. The smallest identifier
    stays, null identifiers come last; of rows that repeat an identifier and text exactly one stays. An
    empty table gives no rows; other columns are not looked at.
    """
    rows = pick(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    cuts = splitters(rows, SPREAD * shuffle_partitions(docs))
    keyed = rows.select("doc_id", normalised(F.col("text")).alias("norm")).withColumn("key", sort_key())
    ranged = keyed.select("doc_id", "norm", "key.lead", "key.mark", "key.id", range_of(cuts).alias("range"))

    inside = Window.partitionBy("range").orderBy("lead", "mark", "norm", "id")
    before = F.lag("norm").over(inside)
    runs = (
        ranged.withColumn("starts", before.isNull() | (before != F.col("norm")))
        .withColumn("run", F.sum(F.col("starts").cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("last_run", F.max("run").over(Window.partitionBy("range")))
    )
    at_edge = F.col("starts") & F.col("run").isin(F.lit(1), F.col("last_run"))
    one_run = Window.partitionBy("range", "run")
    thin = checkpointed(
        runs.select(
            "doc_id", "range", "run", "starts",
            F.sha2("norm", 256).alias("text_sha256"),
            F.when(at_edge, F.col("norm")).alias("edge"),
        )
        .withColumn("least", F.min("doc_id").over(one_run))
        .withColumn("size", F.count(F.lit(1)).over(one_run))
    )
    edges = thin.filter("edge is not null")
    groups = edges.groupBy("edge").agg(
        F.min("least").alias("all_least"), F.sum("size").alias("all_size"), F.min("range").alias("first_range")
    )
    joined_runs = edges.join(groups, "edge").select("range", "run", "all_least", "all_size", "first_range")
    found = thin.drop("edge").join(joined_runs, ["range", "run"], "left")
    return found.select(
        "doc_id",
        F.coalesce("all_least", "least").alias("keep_id"),
        F.coalesce("all_size", "size").alias("group_size"),
        (F.col("starts") & (F.coalesce("first_range", "range") == F.col("range"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` does not keep; same columns.

    Rows that repeat an identifier and text all stay or all go, as nothing tells them apart.
    """
    sealed, stays = Sealed(docs), exact_duplicates(docs).filter("kept").select("doc_id", "text_sha256")
    digest = F.sha2(normalised(F.coalesce(sealed["text"], F.lit(""))), 256)
    same = sealed["doc_id"].eqNullSafe(stays["doc_id"]) & (digest == stays["text_sha256"])
    return sealed.opened(sealed.frame.join(stays, same, "left_semi"))
