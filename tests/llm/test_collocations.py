"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from obsloom.llm import collocations as C
from obsloom.llm.collocations import Rules
from tables import awkward, awkward_rows, clashing, empty


def plain(rows: list[tuple], rules: Rules) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of rows (text, lang)."""
    count, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, rules.most_words + 1):
                count.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    often = {p: c for p, c in count.items() if c >= rules.support and len(p) > 2}
    found: dict[str, list] = {}
    for (lang, *words), a in often.items():
        cuts = []
        for k in range(1, len(words)):
            one, other = count[(lang, *words[:k])], count[(lang, *words[k:])]
            cuts.append((1000 * a * n[lang] // (one * other), k, one, other))
        inside = any(
            len(p) > len(words) + 1 and p[0] == lang and 100 * c >= rules.percent * a
            and any(list(p[i : i + len(words)]) == words for i in range(1, len(p) - len(words) + 1))
            for p, c in often.items()
        )
        if not inside:
            score, _, one, other = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode("utf-8", "surrogatepass"), one, other))
    out = []
    for lang, rows in found.items():
        for rank, (score, a, phrase, one, other) in enumerate(sorted(rows)[: rules.top], 1):
            out.append((lang, rank, phrase.decode("utf-8", "surrogatepass"), -a, one, other, n[lang], -score))
    return sorted(out)


def found(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()))


def sentences(rng: random.Random, n: int) -> list[tuple]:
    words = ["new", "York", "city", "the", "of", "Été", "漢", "a-b", "x", "ok"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "? "]) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.5:
            text += " in the New York city hall" + rng.choice(["", ".", " of"])
        rows.append((text, rng.choice(["en", "en", "fr", None])))
    return rows


@pytest.mark.parametrize("rules", [Rules(support=4), Rules(most_words=3, support=3, percent=80), Rules(most_words=2, support=5, top=3)])
@pytest.mark.parametrize("shard", [300, 1 << 20])
def test_phrases_are_those_of_a_plain_count(spark, rules, shard):
    rows = sentences(random.Random(rules.most_words), 160)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert found(C.collocations(docs, rules, shard)) == plain(rows, rules)


def test_a_full_bitmap_decides_nothing(spark):
    rows = sentences(random.Random(9), 120)
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert found(C.collocations(docs, Rules(support=4), 400, 7)) == plain(rows, Rules(support=4))


def test_whole_tables_of_any_kind(spark):
    rules = Rules(support=2)
    want = plain([(r[1], r[2]) for r in awkward_rows()], rules)
    assert found(C.collocations(awkward(spark), rules, 5000)) == want
    assert found(C.collocations(clashing(awkward(spark)), rules, 5000)) == want
    assert C.collocations(empty(spark), rules).collect() == []


def test_the_words_of_a_text():
    ids, words, piece = C.tokens(["One two,THREE", "", " \t four\x0bfive ", "é"])
    assert [words.to_pylist()[i].decode() for i in ids] == ["one", "two", "three", "four", "five", "é"]
    assert len(np.unique(piece)) == 5 and piece[0] == piece[1]


def test_large_products_stay_exact(spark, monkeypatch):
    """Scores of counts whose products pass 64 bits, by the same joins on a made table of counts."""
    a, n, one, other = 9 * 10**15, 7 * 10**16, 10**16, 9 * 10**15
    counts = [("en", "x", 1, one), ("en", "y", 1, other), ("en", "x y", 2, a)]
    table = spark.createDataFrame(counts, "lang string, phrase string, n_words int, n long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    monkeypatch.setattr(C, "frequent_phrases", lambda *_: (table, totals))
    row = C.collocations(table).first()
    assert row["score"] == 1000 * a * n // (one * other)


@pytest.mark.parametrize("size", [400, 10**6])
def test_shards_hold_what_they_are_given(size):
    import pyarrow as pa

    texts = [f"abc d{i} " * (i % 9) + "end. Next" for i in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en", "fr"] * 100)], names=["text", "lang"])
    rows = [r for b in C._shards(iter([batch.slice(0, 60), batch.slice(60)]), size) for r in b.to_pylist()]
    got = Counter()
    for row in rows:
        ids, words = C.unpacked(row["ids"], row["words"])
        assert row["n"] == (ids != C.BREAK).sum() and row["chars"] <= size + max(map(len, texts)) or len(rows) == 2
        piece = []
        for i in ids.tolist():
            if i == C.BREAK:
                got[row["lang"], tuple(piece)] += 1
                piece = []
            else:
                piece.append(words[i].decode())
        assert not piece
    want = Counter()
    for i, text in enumerate(texts):
        want.update((["en", "fr"][i % 2], tuple(p.split())) for p in text.lower().split(".") if p.split())
    assert got == want and (len(rows) > 2) == (size == 400)


def test_phrases_of_one_hash_are_told_apart():
    ids = np.array([0, 1, C.BREAK, 2, 3, C.BREAK, 0, 1, C.BREAK, 2, 3, 0, C.BREAK], dtype=np.int32)
    same = np.full(4, 7, dtype=np.uint64)
    _, count, place = C.phrases_of(ids, same, 2, None)
    assert sorted((tuple(ids[p : p + 2]), c) for p, c in zip(place, count)) == [((0, 1), 2), ((2, 3), 2), ((3, 0), 1)]
    _, count, place = C.phrases_of(ids, same, 1, None)
    assert sorted((int(ids[p]), int(c)) for p, c in zip(place, count)) == [(0, 3), (1, 2), (2, 2), (3, 2)]


def test_numbers_add_up_over_shards():
    rng = np.random.default_rng(5)
    shards = []
    total, marked = Counter(), set()
    for _ in range(6):
        hashes = np.unique(rng.integers(0, 1 << 64, size=300, dtype=np.uint64) & np.uint64(0xFF00000000FFFFFF) | np.uint64(7 << 50))
        count = rng.integers(1, 9, size=len(hashes))
        often = rng.random(len(hashes)) < 0.3
        shards.append(C.packed(hashes, count, often, 12))
        for h, n, o in zip((hashes >> np.uint64(24)).tolist(), count.tolist(), often.tolist()):
            total[h] += n
            marked |= {h} if o else set()
        back, counts, marks = C.counts_of(shards[-1])
        assert (back >> np.uint64(24) == hashes >> np.uint64(24)).all() and (counts == np.minimum(count, 12)).all() and (marks == often).all()
    got = {int(h) >> 24 for h in C.may_be_frequent(shards, 12)}
    assert got == {h for h, n in total.items() if n >= 12 and h in marked} and got


def test_counts_of_equal_phrases_add_up():
    one = C.tallied(np.array([5, 2**63 + 1], dtype=np.uint64), np.array([3, 4]), ["é x".encode(), b"a"])
    other = C.tallied(np.array([7, 2**63 + 1], dtype=np.uint64), np.array([9, 2**40]), [b"b c", b"a"])
    phrase, hashes, n = C.sums_of([one, other], 4)
    assert sorted(zip(phrase.to_pylist(), hashes.view(np.uint64).tolist(), n.tolist())) == [(b"a", 2**63 + 1, 2**40 + 4), (b"b c", 7, 9)]
