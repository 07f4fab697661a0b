"""Exact dedup and mixing against plain Python."""

import random
from collections import Counter, defaultdict

from obsloom.llm import exact_dedup, mixing
from tables import norm, prose


def test_large_groups_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SPREAD", 16)
    rng = random.Random(1)
    texts = [prose(rng, 8) for _ in range(30)]
    texts = [*texts, texts[0] + " ", texts[0].replace(" ", "\t\n")]
    rows = [(i, rng.choices(texts, weights=[60] + [1] * (len(texts) - 1))[0]) for i in rng.sample(range(10_000), 900)]
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[norm(text)].append(doc_id)
    want = {i: (min(groups[norm(t)]), len(groups[norm(t)]), i == min(groups[norm(t)])) for i, t in rows}
    got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in got} == want


def goals(sizes: dict, weights: dict) -> dict:
    """Targets by resharing until nobody is above the cap."""
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        share = sum(weights[s] for s in sizes if s not in capped)
        target = {s: 2 * sizes[s] if s in capped else left * weights[s] / share for s in sizes}
        over = {s for s in sizes if target[s] > 2 * sizes[s]} - capped
        if not over:
            return target
        capped |= over


def test_budgets_are_exact_and_capped(spark):
    rng = random.Random(2)
    sources = ["b", "a", None, "ä", "Z", ""]
    rows = [(i, prose(rng, rng.randint(0, 40)), rng.choices(sources, weights=[9, 40, 3, 2, 5, 1])[0]) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    target = goals(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    source_of = {i: s for i, _, s in rows}
    plan = mixing.mix_plan(docs).collect()
    taken = Counter()
    for r in plan:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert abs(r["target"] - target[source_of[r["doc_id"]]]) < 1e-6 and r["source_size"] == sizes[source_of[r["doc_id"]]]
        taken[source_of[r["doc_id"]]] += r["taken"]
    for source in sizes:
        assert target[source] - 1 < taken[source] <= target[source] + 1e-6
    assert sorted(map(tuple, plan)) == sorted(map(tuple, mixing.mix_plan(docs.repartition(9)).collect()))
    mixed = Counter(r["doc_id"] for r in mixing.mix_documents(docs).collect())
    assert all(abs(mixed[r["doc_id"]] * r["size"] - r["taken"]) * 2 <= r["size"] for r in plan)
