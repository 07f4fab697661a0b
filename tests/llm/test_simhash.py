"""SimHash against all pairs of plainly computed fingerprints."""

import random

import numpy as np
import pytest
import xxhash

from obsloom.llm import simhash as S
from tables import awkward, awkward_rows, clashing, empty, prose


def plain_fingerprint(text, words=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    n = min(words, len(found))
    hashes = [xxhash.xxh64(b" ".join(found[i : i + n]), seed=42).intdigest() for i in range(len(found) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=2, words=3):
    fps = [plain_fingerprint(text, words) for _, text in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                label[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((d, f"{f:016x}", least.get(root(i))) for i, ((d, _), f) in enumerate(zip(rows, fps))), key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def near_texts(seed, groups=6):
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        base = prose(rng, rng.randint(100, 400)).split(" ")
        for _ in range(12):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 9])):
                words[rng.randrange(len(words))] = prose(rng, 1)
            rows.append(" ".join(words))
    rows += ["", " ", "a", "A", "a b", "A\tb", "a b c"] + rows[:3]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 7])
def test_components_are_those_of_all_pairs(spark, radius):
    rows = near_texts(radius)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(S.simhash_components(docs, radius=radius)) == plain_components(rows, radius)


def test_other_shingles(spark):
    rows = near_texts(11, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(S.simhash_components(docs, words=5)) == plain_components(rows, 2, 5)


def test_whole_tables_of_any_kind(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    want = plain_components(rows)
    assert found(S.simhash_components(awkward(spark))) == want
    assert found(S.simhash_components(clashing(awkward(spark)))) == want
    assert S.simhash_components(empty(spark)).collect() == []


def test_long_texts_are_hashed_in_parts_alike(monkeypatch):
    text = prose(random.Random(5), 3000)
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "PART", 50)
    assert S.fingerprint(text) == whole == plain_fingerprint(text)


def clusters(rng, n, centres, flips):
    base = rng.integers(0, 1 << 64, size=centres, dtype=np.uint64)
    fps = base[rng.integers(0, centres, size=n)]
    for _ in range(flips):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, size=n, dtype=np.uint64))
    return np.unique(fps)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 8])
def test_bit_planes_find_the_pairs_of_every_group(radius):
    rng = np.random.default_rng(radius)
    fps = clusters(rng, 700, 20, 3)
    group = np.sort(rng.integers(0, 9, size=len(fps)))
    got = {(int(i), int(j)) for one, other in S.near_pairs(fps, group, radius) for i, j in zip(one, other)}
    want = {
        (i, j) for i in range(len(fps)) for j in range(i + 1, len(fps))
        if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= radius
    }
    assert got == want


def test_labels_join_what_is_linked():
    rng = np.random.default_rng(3)
    one, other = rng.integers(0, 400, size=(2, 300))
    label = S.connected(S.connected(np.arange(400), one[:100], other[:100]), one, other)
    plain = list(range(400))
    for _ in range(400):
        for a, b in zip(one.tolist(), other.tolist()):
            plain[a] = plain[b] = min(plain[a], plain[b])
    assert label.tolist() == plain


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_finer_groups_lose_no_pair(radius):
    rng = random.Random(radius)
    for _ in range(200):
        one = rng.getrandbits(64)
        other = one
        for bit in rng.sample(range(64), radius):
            other ^= 1 << bit
        mask = 0
        while 64 - mask.bit_count() > 12:
            agree = [m for m in S.finer(mask, radius) if one & m == other & m]
            assert agree
            mask = rng.choice(agree)


@pytest.mark.parametrize("group", [3, 40])
def test_hot_groups_are_split(spark, group, monkeypatch):
    """All fingerprints agree in a third of their bits, so that this group is dealt again and again."""
    monkeypatch.setattr(S, "LEAST_BITS", 3)
    rng = np.random.default_rng(group)
    fps = clusters(rng, 500, 25, 2) & np.uint64((1 << 43) - 1)
    table = spark.createDataFrame([(int(f),) for f in np.unique(fps)], "fp long")
    labels = {r["id"]: r["label"] for r in S.components(S.near_links(table, 2, group)).collect()}
    fps = np.unique(fps).tolist()
    plain = {f: f for f in fps}
    for _ in range(30):
        for a in fps:
            plain[a] = min(plain[b] for b in fps if (a ^ b).bit_count() <= 2)
    assert {f: labels.get(f, f) for f in fps} == plain


def test_the_radius_has_a_bound(spark):
    with pytest.raises(ValueError):
        S.near_links(spark.createDataFrame([(1,)], "fp long"), 12)
