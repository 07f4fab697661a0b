"""Importance resampling against plain counts and a plain sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from obsloom.llm import resampling as R
from obsloom.llm.resampling import Draw
from tables import awkward, awkward_rows, clashing, empty, prose


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_features(text, draw):
    words = plain_words(text)
    runs = [" ".join(words[i : i + n]) for n in range(1, draw.run + 1) for i in range(len(words) - n + 1)]
    return [zlib.crc32(r.encode()) % draw.buckets for r in runs]


def plain(rows, target, draw):
    """(doc_id, n_features, weight, score, rank) of rows (doc_id, text)."""
    source, wanted = Counter(), Counter()
    for _, text in rows:
        source.update(plain_features(text, draw))
    for text in target:
        wanted.update(plain_features(text, draw))
    all_s, all_t = sum(source.values()), sum(wanted.values())
    out = []
    for doc_id, text in rows:
        found = plain_features(text, draw)
        gains = [
            math.floor(1000 * math.log((wanted[b] + 1) * (all_s + draw.buckets) / ((source[b] + 1) * (all_t + draw.buckets)))) for b in found
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(plain_words(text)) >= draw.least_words])
    drawn = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(drawn[: len(drawn) * draw.percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some_rows(rng, n):
    rows = [(i, prose(rng, rng.choice([0, 5, 19, 20, 21, 60]))) for i in range(n)]
    rows += [(3, rows[5][1]), (7, rows[7][1]), (7, rows[7][1]), (None, prose(rng, 30)), (None, prose(rng, 30))]
    return rows


@pytest.mark.parametrize("draw", [Draw(), Draw(run=2, buckets=97, percent=35), Draw(run=3, buckets=10, least_words=1, percent=100)])
def test_rows_are_those_of_a_plain_sort(spark, draw):
    rng = random.Random(draw.run)
    rows, target = some_rows(rng, 300), [prose(rng, 80), "The end THE end", None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    assert found(R.resample(docs, bench, draw)) == plain(rows, target, draw)


def test_whole_tables_of_any_kind(spark):
    rows, draw = [(r[0], r[1]) for r in awkward_rows()], Draw(percent=60)
    target = spark.createDataFrame([("the end",)], "text string")
    want = plain(rows, ["the end"], draw)
    assert found(R.resample(awkward(spark), target, draw)) == want
    assert found(R.resample(clashing(awkward(spark)), target, draw)) == want
    assert R.resample(empty(spark), target).collect() == []
    assert found(R.resample(awkward(spark), target.limit(0), draw)) == plain(rows, [], draw)


def test_many_copies_of_one_row(spark):
    rng = random.Random(1)
    rows = [(1, prose(rng, 30))] * 400 + [(i, prose(rng, 30)) for i in range(2, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    draw = Draw(percent=50)
    target = spark.createDataFrame([("the end",)], "text string")
    assert found(R.resample(docs, target, draw)) == plain(rows, ["the end"], draw)


@pytest.mark.parametrize("parts", [1, 2, 9])
def test_the_cutoff_of_every_place(spark, parts):
    rng = random.Random(parts)
    keys = [(rng.randint(-3, 3), 0, rng.randint(0, 4), rng.randint(0, 1)) for _ in range(60)]
    table = spark.createDataFrame(keys, ", ".join(f"{c} long" for c in R.KEY)).repartition(parts).persist()
    for place in (1, 2, 17, 30, 31, 59, 60):
        assert R.cutoff(table, place) == sorted(keys)[place - 1]
    table.unpersist()


def test_every_round_discards_a_quarter():
    rng = np.random.default_rng(2)
    for _ in range(200):
        parts = [rng.integers(0, 50, size=(rng.integers(1, 40), 4)) for _ in range(rng.integers(1, 9))]
        pivot = R.weighted_median([(tuple(R._median(p)), len(p)) for p in parts])
        keys = np.concatenate(parts)
        before = int(R.below(keys, pivot).sum())
        equal = int((keys == np.array(pivot)).all(axis=1).sum())
        assert 4 * (before + equal) >= len(keys) and 4 * (len(keys) - before) >= len(keys)
