"""Small tables with every awkward case, and plain Python versions of what the operators compute."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names are those of results and of working columns.
CLASHING = ["TEXT", "kept", "mark", "range", "n", "id", "words", "places", "host", "size", "label", "key"]

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng: random.Random, words: int) -> str:
    stems = ["an", "re", "tion", "the", "ou", "sh", "er", "nd", "ea", "ble", "ti", "st"]
    return " ".join("".join(rng.choices(stems, k=rng.randint(1, 3))) for _ in range(words))


def awkward_rows() -> list[tuple]:
    rng = random.Random(4)
    base = prose(rng, 120)
    swapped = base.split(" ")
    swapped[60] = "changed"
    passage = "\n".join(prose(rng, 20) for _ in range(6))
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base + " more", "en", None),
        (3, " ".join(swapped), "en", "b"),
        (4, None, "en", "a"),
        (5, "", None, "a"),
        (6, " \n\t ", "fr", ""),
        (7, "one two", "en", "b"),
        (8, "one\x0btwo", "en", "b"),
        (9, "word " * 90, "en", None),
        (10, prose(rng, 30_000), "fr", "a"),
        (11, "x" * 70_000, "fr", "a"),
        (None, base, "en", "a"),
        (None, None, None, None),
        (None, prose(rng, 70), "fr", "b"),
        (12, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 30), "fr", "b"),
        (13, prose(rng, 25) + "\n" + prose(rng, 25) + "\n" + passage, "fr", "c"),
        (14, passage + "\n" + passage, "fr", "c"),
        (15, "é漢字🙂 <|endoftext|> ​" + prose(rng, 55), "fr", "c"),
    ]
    return [(*row, None if row[1] is None else len(row[1])) for row in rows]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def clashing(df):
    """The table with further columns before and after its own."""
    from pyspark.sql import functions as F

    wide = df.select(F.lit("other").alias("TEXT"), "*", *[F.lit(0).alias(name) for name in CLASHING[1:]])
    return wide


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def norm(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def shingles(text: str | None, size: int) -> frozenset:
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def linked(one: frozenset, other: frozenset, percent: int) -> bool:
    return bool(one) and bool(other) and 100 * len(one & other) >= percent * len(one | other)


def brute_components(rows: list[tuple], size: int = 3, percent: int = 90) -> list[tuple]:
    """(doc_id, n_shingles, smallest reachable doc_id) of rows (doc_id, text), all pairs compared."""
    sets = [shingles(text, size) for _, text in rows]
    label = list(range(len(rows)))

    def root(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                label[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(doc_id, len(s), least.get(root(i), doc_id)) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))]
