"""Importance resampling towards a target: documents whose features are more usual there are drawn more often.

Features are runs of words, hashed to a fixed number of buckets. A bucket's gain is the logarithm of how much more
frequent it is in the target than in the documents; a document's weight is the mean gain of its features, taken
from arrays. Weight plus a Gumbel number from the identifier is the score, and the highest scores are drawn.

The score of the last drawn document is found without a sort: each partition names the median of the keys that are
still open, and the median of these medians, each weighted by its partition's open keys, has at least a quarter of
all open keys on either side. Counting them tells on which side the cutoff lies, and the other side is discarded.
Only the winners are sorted, range by range.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsloom.llm.byte_bpe import slices
from obsloom.llm.texts import pick, stored, whole_text
from obsloom.operators.ranges import cut_points, default_ranges, range_number
from obsloom.operators.sizes import measured

#: Rows of text that are worked on at once.
ROWS = 512

_KIND = np.zeros(256, dtype=bool)  # whether a byte belongs to a word, once A-Z are lower-case
_KIND[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Draw:
    """Features of 1 to ``run`` words in ``buckets`` buckets; of documents with ``least_words`` words ``percent`` are drawn."""

    run: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"


def features(texts: list[str], run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every feature of the texts, and the number of words of each text."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = b"\0".join(raws).translate(_LOWER)
    codes = np.frombuffer(raw, dtype=np.uint8)
    inside = _KIND[codes]
    edge = np.zeros(1, dtype=bool)
    starts = np.flatnonzero(inside & ~np.concatenate([edge, inside[:-1]]))
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], edge])) + 1
    sizes = np.array([len(r) + 1 for r in raws], dtype=np.int64)
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    offsets = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(ends - starts)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(codes[inside])])
    text, bucket = [], []
    for n in range(1, min(run, len(starts)) + 1):
        whole = np.flatnonzero(owner[: len(starts) - n + 1] == owner[n - 1 :])
        runs = [words.slice(i, len(starts) - n + 1) for i in range(n)]
        named = (pc.binary_join_element_wise(*runs, pa.scalar(b" ", pa.large_binary())) if n > 1 else words).dictionary_encode()
        hashed = np.fromiter((zlib.crc32(w) % buckets for w in named.dictionary.to_pylist()), dtype=np.int64, count=len(named.dictionary))
        text.append(owner[whole])
        bucket.append(hashed[named.indices.to_numpy(zero_copy_only=False)[whole]])
    counts = np.bincount(owner, minlength=len(texts))
    if not text:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), counts
    return np.concatenate(text), np.concatenate(bucket), counts


def bucket_counts(docs: DataFrame, draw: Draw) -> np.ndarray:
    """How many features of all texts are in each bucket; a number for each bucket comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(draw.buckets, dtype=np.int64)
        for batch in slices(batches, ROWS):
            totals += np.bincount(features(batch.column("text").to_pylist(), draw.run, draw.buckets)[1], minlength=draw.buckets)
        (bucket,) = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(totals[bucket])], names=["bucket", "n"])

    rows = pick(docs, "text").select(whole_text().alias("text")).mapInArrow(count, "bucket long, n long")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros(draw.buckets, dtype=np.int64)
    totals[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return totals


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) of each bucket."""
    n = len(source)
    all_s, all_t = float(int(source.sum()) + n), float(int(target.sum()) + n)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64
    )


def weights(docs: DataFrame, gains: np.ndarray, draw: Draw) -> DataFrame:
    """(doc_id, n_features, weight, fits): the floored mean gain of every row, and whether it has words enough."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            text, bucket, words = features(batch.column("text").to_pylist(), draw.run, draw.buckets)
            n = np.bincount(text, minlength=batch.num_rows)
            # sums of whole numbers far below 2**53 are exact in doubles
            total = np.bincount(text, weights=shared.value[bucket], minlength=batch.num_rows).astype(np.int64)
            weight = np.floor_divide(total, np.maximum(n, 1))
            columns = [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(weight), pa.array(words >= draw.least_words)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "weight", "fits"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(weigh, "doc_id long, n_features long, weight long, fits boolean")


def gumbel(seed: str, doc_id: Column) -> Column:
    """floor(-1000 * ln(-ln(u))) of a number u between 0 and 1 from a hash of the seed and the identifier."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


#: The order of the draw: score downwards, identifier upwards, no identifier last. The number of features only
#: tells rows apart that share all of these; rows that share it too are alike in every result.
KEY = ["down", "no_id", "id", "n_features"]


def ordered(keys: np.ndarray) -> np.ndarray:
    """Rows of ``keys`` (row, column) in ascending order."""
    return keys[np.lexsort(keys.T[::-1])]


def below(keys: np.ndarray, key: tuple[int, ...]) -> np.ndarray:
    """Which rows of ``keys`` come before ``key``."""
    less, same = np.zeros(len(keys), dtype=bool), np.ones(len(keys), dtype=bool)
    for column, value in zip(keys.T, key):
        less |= same & (column < value)
        same &= column == value
    return less


Key = tuple[int, ...]


def _median(keys: np.ndarray) -> list[int]:
    return ordered(keys)[(len(keys) - 1) // 2].tolist() if len(keys) else [0] * len(KEY)


def _looks(batches: Iterator[pa.RecordBatch], low: Key | None, high: Key | None, pivot: Key | None) -> Iterator[pa.RecordBatch]:
    """Of the keys between ``low`` and ``high``, both left out: numbers and medians of those before and after ``pivot``."""
    kept, equal = [np.zeros((0, len(KEY)), dtype=np.int64)], 0
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in KEY], axis=1)
        if low is not None:
            keys = keys[~below(keys, low) & ~(keys == np.array(low)).all(axis=1)]
        if high is not None:
            keys = keys[below(keys, high)]
        if pivot is not None:
            here = (keys == np.array(pivot)).all(axis=1)
            equal += int(here.sum())
            keys = keys[~here]
        kept.append(keys)
    keys = np.concatenate(kept)
    before = below(keys, pivot) if pivot is not None else np.ones(len(keys), dtype=bool)
    sides = [keys[before], keys[~before]]
    columns = [pa.array([equal], pa.int64())]
    for side in sides:
        columns += [pa.array([len(side)], pa.int64()), pa.array([_median(side)], pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(columns, names=["equal", "n_before", "m_before", "n_after", "m_after"])


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The median at which the weights of those up to it reach half of all."""
    medians = sorted((m, w) for m, w in medians if w)
    half, running = sum(w for _, w in medians), 0
    for key, weight in medians:
        running += weight
        if 2 * running >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, wanted: int) -> Key:
    """The key at place ``wanted`` (from 1) of the rows of ``keys`` in the order of ``KEY``.

    Each round reads the keys once. Two rows for each partition come to the driver, and a partition holds its open keys.
    """

    def look(low: Key | None, high: Key | None, pivot: Key | None) -> pa.Table:
        shape = "equal long, n_before long, m_before array<long>, n_after long, m_after array<long>"
        return keys.select(*KEY).mapInArrow(lambda batches: _looks(batches, low, high, pivot), shape).toArrow()

    def pivot_of(found: pa.Table, side: str) -> Key:
        return weighted_median(list(zip(map(tuple, found.column(f"m_{side}").to_pylist()), found.column(f"n_{side}").to_pylist())))

    low = high = None
    pivot = pivot_of(look(None, None, None), "before")
    while True:
        found = look(low, high, pivot)
        n_before, n_equal = (sum(found.column(c).to_pylist()) for c in ("n_before", "equal"))
        if n_before < wanted <= n_before + n_equal:
            return pivot
        if wanted <= n_before:
            high, pivot = pivot, pivot_of(found, "before")
        else:
            low, pivot, wanted = pivot, pivot_of(found, "after"), wanted - n_before - n_equal


def resample(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank; ``target`` has a column text.

    ``rank`` counts the drawn rows from 1, by score downwards, then by identifier, and is null for the others. Null
    texts count as empty; without a feature the weight is 0. Rows without an identifier come last among equal scores
    and share one random number, as rows that repeat an identifier do. An empty table gives no rows; an empty target
    leaves its counts at 0. Other columns are not looked at.
    """
    gains = bucket_gains(bucket_counts(docs, draw), bucket_counts(target, draw))
    rows = weights(docs, gains, draw)
    rows = rows.withColumn("score", F.col("weight") + gumbel(draw.seed, F.col("doc_id")))
    rows = rows.withColumns({"down": -F.col("score"), "no_id": F.col("doc_id").isNull().cast("long"), "id": F.coalesce("doc_id", F.lit(0))})
    rows = stored(rows, "scores")
    fits = rows.filter("fits")
    wanted = fits.count() * draw.percent // 100
    result = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return rows.select(*result, F.lit(None).cast("long").alias("rank"))
    last = F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(KEY, cutoff(fits, wanted))])
    within = F.col("fits") & (F.struct(*KEY) <= last)
    losers = rows.filter(~within).select(*result, F.lit(None).cast("long").alias("rank"))
    return ranked(rows.filter(within), wanted, result).unionByName(losers)


def ranked(winners: DataFrame, wanted: int, result: list[str]) -> DataFrame:
    """The rows with their ``rank`` in the order of ``KEY``, which is null beyond ``wanted``; rows that are alike are counted, then given back."""
    alike = stored(winners.groupBy(*KEY, *[c for c in result if c not in KEY]).agg(F.count(F.lit(1)).alias("copies")), "winners")
    cuts = cut_points(alike, KEY, default_ranges(winners))
    placed = alike.withColumn("range", range_number(alike, KEY, cuts))
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("range").agg(F.sum("copies").alias("in_range"))
    offsets = sums.select("range", F.coalesce(F.sum("in_range").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("range").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, -1)
    counted = placed.withColumn("earlier", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(measured(offsets), "range")
    first = F.col("offset") + F.col("earlier")
    each = counted.select(*result, F.explode(F.sequence(first + 1, first + F.col("copies"))).alias("place"))
    return each.select(*result, F.when(F.col("place") <= wanted, F.col("place")).alias("rank"))
