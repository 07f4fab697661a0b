"""The shingle join against all pairs."""

import random

import numpy as np
import pytest

from obsloom.llm import ngram_join
from obsloom.llm.components import components
from obsloom.llm.ngram_join import Measure
from obsloom.llm.shingles import shingle_set, word_hashes
from tables import brute_components, linked, prose, shingles


def test_words_and_shingles_of_any_bytes():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices("aAbé\t\n\x0b\x0c\r \x1c 漢", k=rng.randint(0, 30)))
        words = text.encode().lower().split()
        assert len(word_hashes(text)) == len(words) and len(np.unique(word_hashes(text))) == len(set(words))
        assert len(shingle_set(text, 3)) == len(shingles(text, 3))


def test_long_texts_are_hashed_in_parts_alike(monkeypatch):
    text = prose(random.Random(5), 3000)
    whole = shingle_set(text)
    monkeypatch.setattr("obsloom.llm.shingles.PART", 50)
    assert (shingle_set(text) == whole).all()


@pytest.mark.parametrize("measure", [Measure(), Measure(5, 80), Measure(1, 50)])
def test_linked_sets_share_a_part(measure):
    rng = np.random.default_rng(1)
    bounds, met = measure.class_bounds(4000), 0
    for _ in range(400):
        n = int(rng.integers(1, 300))
        one = np.unique(rng.integers(0, 1 << 63, size=n, dtype=np.uint64))
        drop, add = rng.integers(0, max(1, n // 5), size=2)
        other = np.unique(np.concatenate([rng.permutation(one)[drop:], rng.integers(0, 1 << 63, size=int(add), dtype=np.uint64)]))
        if len(other) and len(one) and measure.linked(one, other) and len(np.setxor1d(one, other)):
            met += 1
            assert np.intersect1d(measure.signatures(one, bounds), measure.signatures(other, bounds)).size
    assert met > 30


def near_rows(rng: random.Random) -> list[tuple]:
    """Groups around a base text with few to many changes, chains of changes, copies, and short texts."""
    rows = []
    for _ in range(4):
        base = prose(rng, rng.randint(60, 150)).split(" ")
        for _ in range(14):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 5, 8])):
                words[rng.randrange(len(words))] = prose(rng, 1) + "q"
            rows.append(" ".join(words))
        words = list(base)
        for i in range(8):
            words[-1 - 3 * i] = f"step{i}"
            rows.append(" ".join(words))
    rows += rows[:6] + [prose(rng, 40) for _ in range(10)] + ["a", "a", "A b", "a  b", "", " "]
    rng.shuffle(rows)
    return [(i * 3 + 1, text) for i, text in enumerate(rows)]


@pytest.mark.parametrize("measure", [Measure(), Measure(5, 80)])
def test_components_and_links_equal_all_pairs(spark, measure):
    rows = near_rows(random.Random(11))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_join.similar_components(docs, measure)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(
        brute_components(rows, measure.words, measure.percent)
    )
    sets: dict = {}
    for doc_id, text in rows:
        sets.setdefault(shingles(text, measure.words), doc_id)
    keys = [k for k in sets if k]
    want = {tuple(sorted((sets[a], sets[b]))) for i, a in enumerate(keys) for b in keys[:i] if linked(a, b, measure.percent)}
    pairs = [tuple(r) for r in ngram_join.similar_pairs(docs, measure).collect()]
    assert set(pairs) == want and len(pairs) == len(want) > 50


def test_sets_that_meet_in_different_tasks_or_batches_are_open(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HELD", 1)
    rows = near_rows(random.Random(12))[:40]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = ngram_join.similar_components(docs).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute_components(rows))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(200, 260)] + [(i, 7) for i in (300, 301)]
    rng.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(200, 260)} == {1} and got[300] == got[301] == 7


def test_frequencies_over_batches(monkeypatch):
    monkeypatch.setattr(ngram_join, "MANY", 5)
    rng = np.random.default_rng(3)
    for _ in range(200):
        token = np.sort(rng.integers(0, 6, size=int(rng.integers(0, 40))))
        cuts = np.sort(rng.integers(0, len(token) + 1, size=4))
        parts = zip(np.split(token, cuts), np.split(np.arange(len(token)), cuts))
        found = ngram_join._frequencies(ngram_join._longs(t, i, names=["token", "id"]) for t, i in parts)
        got = sorted(tuple(r.values()) for batch in found for r in batch.to_pylist())
        size = {t: int((token == t).sum()) for t in set(token.tolist())}
        assert got == sorted((t, i, min(size[t], 5)) for i, t in enumerate(token.tolist()) if size[t] > 1)
