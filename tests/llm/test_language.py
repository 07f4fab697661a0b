"""Language inference: held-out accuracy, mixtures, what a prediction may see, and a plain version of it."""

import math
import time
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from obsloom.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.train_and_predict(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert right[0] > 0.97 and right[1] > 100
    assert found.filter("score < 0 or score > 1").count() == 0


def test_held_out_rows_and_labels_do_not_reach_the_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    other = docs.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in language.train(other.filter(~language.held_out()).select("text", "lang"))[0]
    plain = sorted(map(tuple, language.train_and_predict(docs).collect()))
    assert sorted(map(tuple, language.train_and_predict(other).collect())) == plain


def test_a_mixture_names_both_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    names, model = language.train(docs.select("text", "lang"))
    text = {r["lang"]: r["text"] for r in docs.filter("length(text) > 2500").collect()}
    found = language.infer([text["de"][:2000] + " " + text["es"][:1000], text["en"]], model)
    both = dict(zip(names, found[0]))
    assert 0.5 < both["de"] < 0.8 and 0.2 < both["es"] < 0.5 and abs(sum(both.values()) - 1) < 1e-6
    assert found[1].max() > 0.9


def test_trigrams_of_one_text_do_not_depend_on_its_neighbours():
    texts = ["", "Ein Haus", "12 !", "a", "ein\0haus", "  EIN  haus "]
    owner, bucket, count = language.trigrams(texts)
    for i, text in enumerate(texts):
        _, alone, n = language.trigrams([text])
        assert bucket[owner == i].tolist() == alone.tolist() and count[owner == i].tolist() == n.tolist()
    assert set(owner) == {1, 3, 4, 5}
    one, same = (language.trigrams([t])[1].tolist() for t in ("Ein Haus", "  EIN  haus "))
    assert set(one) == set(same)


def test_no_labels_at_all(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    row = language.train_and_predict(docs).first()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    assert np.all(language.infer(["text"], language.train(docs)[1]) == 0)


def test_any_of_six_languages_can_be_mixed():
    def text(letters, seed, words):
        rng = np.random.default_rng(seed)
        return " ".join("".join(rng.choice(list(letters), 6)) for _ in range(words))

    latin = "abcdefgh"
    # One script with weights that differ little, and one script of its own.
    weights = [text(latin, i, 4000) for i in range(5)] + [text("あいうえおかきく", 9, 4000)]
    model = []
    for one in weights:
        _, bucket, count = language.trigrams([one])
        total = np.full(65536, 0.01)
        np.add.at(total, bucket, count)
        model.append(np.log(total / total.sum()))
    mixed = text(latin, 0, 120) + " " + text("あいうえおかきく", 9, 80)
    found = language.infer([mixed], np.array(model))[0]
    assert found[5] > 0.2 and found[:5].sum() > 0.4


def plain_trigrams(text):
    """Trigrams of lower-case letters, every run of other characters and both ends one space, by a plain loop."""
    spaced = " "
    for char in text.replace("\0", " ").lower():
        spaced += char if char.isalpha() else "" if spaced.endswith(" ") else " "
    spaced += "" if spaced.endswith(" ") else " "
    found = [spaced[i : i + 3] for i in range(len(spaced) - 2)]
    return Counter(g for g in found if g[1] != " " or (g[0] != " " and g[2] != " "))


def plain_inference(text, model, bucket_of):
    """Expectation maximisation and the penalised choice, one trigram at a time."""
    counts = Counter()
    for gram, n in plain_trigrams(text).items():
        counts[bucket_of(gram)] += n
    total, labels = sum(counts.values()), range(len(model))
    if not total:
        return [0.0] * len(model)

    def mixed(chosen):
        share = {i: 1 / len(chosen) for i in chosen}
        for _ in range(language.ROUNDS):
            new = dict.fromkeys(chosen, 0.0)
            for bucket, n in counts.items():
                parts = {i: share[i] * math.exp(model[i][bucket]) for i in chosen}
                whole = sum(parts.values())
                for i in chosen:
                    new[i] += n * parts[i] / whole
            share = {i: v / total for i, v in new.items()}
        fit = sum(n * math.log(sum(share[i] * math.exp(model[i][b]) for i in chosen)) for b, n in counts.items())
        return share, fit

    share, _ = mixed(list(labels))
    alone = {i: sum(n * float(model[i][b]) for b, n in counts.items()) for i in labels}
    order = sorted(labels, key=lambda i: (-share[i], -alone[i]))
    size = max(1, sum(v >= language.LEAST_SHARE for v in share.values()))
    best, best_fit = None, -math.inf
    for n in range(1, size + 1):
        own, fit = mixed(order[:n])
        fit -= language.PRICE * math.log(total + 1) * (n - 1)
        if fit > best_fit:
            best, best_fit = own, fit
    return [best.get(i, 0.0) for i in labels]


def test_inference_is_that_of_a_plain_loop(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names, model = language.train(docs.filter("doc_id % 3 = 0").select("text", "lang"))
    rows = [r["text"][:600] for r in docs.filter("text is not null").orderBy("doc_id").limit(12).collect()]
    texts = [*rows, rows[0][:300] + " " + rows[5][:200], "", "12 !", "a", "Ein Haus"]

    def bucket_of(gram):
        code = [0 if c == " " else ord(c) for c in gram]
        mask = (1 << 64) - 1
        mixed = (code[0] * 0x9E3779B97F4A7C15 + code[1] * 0xC2B2AE3D27D4EB4F + code[2] * 0x165667B19E3779F9) & mask
        return ((mixed ^ (mixed >> 29)) * 0xBF58476D1CE4E5B9 & mask) >> 48

    got = language.infer(texts, model)
    for text, row in zip(texts, got):
        assert np.allclose(row, plain_inference(text, model, bucket_of), atol=1e-4), text[:50]


def test_many_labels_take_time_in_proportion():
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdefgh "), 200)) for _ in range(64)]

    def seconds(labels):
        model = np.log(rng.dirichlet(np.ones(language.BUCKETS), size=labels)).astype(np.float32)
        start = time.perf_counter()
        language.infer(texts, model)
        return time.perf_counter() - start

    seconds(4)
    assert seconds(64) < 60 * max(seconds(4), 0.01)
