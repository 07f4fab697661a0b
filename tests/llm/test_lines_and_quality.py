"""Line dedup and quality rules on planted passages; their SQL runs with the other queries."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from obsloom.llm import line_dedup, quality, texts
from tables import prose


def doc(rng, *parts):
    return "\n".join(x for part in parts for x in ([prose(rng, rng.randint(5, 25)) for _ in range(part)] if isinstance(part, int) else part))


def test_shared_passages_go_and_clean_lines_stay(spark):
    rng = random.Random(6)
    passage = [prose(rng, 12) for _ in range(12)]
    long_line = [prose(rng, 80)]
    texts = [doc(rng, 4, passage, 3), doc(rng, 1, passage, 6), doc(rng, 7), doc(rng, 2, long_line, 2), doc(rng, 5, long_line), doc(rng, 6, passage)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in line_dedup.line_report(docs).collect()}
    assert [got[i]["n_removed_lines"] for i in (0, 2, 3)] == [0, 0, 0]
    for i in (1, 5):
        kept = set(got[i]["clean_text"].split("\n"))
        assert sum(line not in kept for line in passage) >= 6
        assert all(line in kept for line in texts[i].split("\n") if line not in passage)
    assert got[4]["clean_text"] == "\n".join(x for x in texts[4].split("\n") if x not in long_line)
    assert got[0]["clean_text"] == texts[0]


def cleaned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup_lines(docs).collect()}


def test_passages_of_long_lines_go(spark):
    rng = random.Random(16)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(n))
    han = lambda n: "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(n))
    for passage in ([words(30) for _ in range(3)], [han(250)], [han(60), "", han(60)]):
        texts = [[words(30), *passage, words(31)], [words(22), words(33), *passage], [*passage, words(40)], [passage[0][:40], words(21)]]
        got = cleaned(spark, ["\n".join(t) for t in texts])
        assert got[0] == texts[0] and got[1] == texts[1][:2] and got[2] == texts[2][-1:] and got[3] == texts[3]


def test_short_passages_of_ordinary_lines_go_whole(spark):
    rng = random.Random(18)
    passages = [[prose(rng, n) for n in sizes] for size in range(3, 9) for sizes in ([-(-50 // size)] * size, [49, 1] + [2] * (size - 2), [2] * (size - 2) + [1, 49])]
    texts = [[prose(rng, 20), *p, prose(rng, 20)] for p in passages] + [[prose(rng, 9), prose(rng, 8), *p, prose(rng, 7)] for p in passages]
    got, n = cleaned(spark, ["\n".join(t) for t in texts]), len(passages)
    assert all(got[i] == texts[i] for i in range(n))
    assert all(got[n + i] == texts[n + i][:2] + texts[n + i][-1:] for i in range(n))


def test_repeated_runs_are_those_of_brute_force(spark):
    rng = random.Random(19)
    pool = [prose(rng, rng.choice([1, 4, 12, 20, 60])) for _ in range(12)] + ["", " "]
    texts = [rng.choices(pool, k=rng.randint(1, 9)) for _ in range(60)]
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(r["doc_id"], i) for r in line_dedup.repeated_windows(docs).collect() for i in range(r["first"], r["last"] + 1)}
    chunks = {(r["doc_id"], i) for r in line_dedup.gone_chunks(docs).collect() for i in range(r["first"], r["last"] + 1)}
    runs, want = {}, set()
    for d, lines in enumerate(texts):
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = lines[a : b + 1]
                if run[0].strip() and run[-1].strip() and len(" ".join(run).split()) >= 50:
                    at = runs.setdefault(tuple(run), (d, b))
                    if at[0] != d or a > at[1]:
                        want |= {(d, i) for i in range(a, b + 1)}
    assert got == want and want
    report = {r["doc_id"]: r for r in line_dedup.line_report(docs).collect()}
    for d, lines in enumerate(texts):
        left = [line for i, line in enumerate(lines) if (d, i) not in want | chunks]
        assert report[d]["clean_text"] == "\n".join(left) and report[d]["n_removed_lines"] == len(lines) - len(left)


@pytest.mark.parametrize("size", [2, 3, 4, 5, 8, 12])
def test_the_report_finds_passages_of_any_number_of_lines(spark, size):
    rng = random.Random(size)
    passage = [prose(rng, 50 // size + 2) for _ in range(size)]
    texts = [[prose(rng, 20), *passage, prose(rng, 20)], [prose(rng, 9), *passage, prose(rng, 7)]]
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["clean_text"].split("\n") for r in line_dedup.line_report(docs).collect()}
    assert got == {0: texts[0], 1: [texts[1][0], texts[1][-1]]}


def test_copies_leave_no_stubs(spark):
    rng = random.Random(22)
    lines = [prose(rng, 14) for _ in range(30)]
    near = lines[:10] + [prose(rng, 14)] + lines[11:20] + [prose(rng, 14)] + lines[21:]
    some = [prose(rng, 14) for _ in range(20)] + lines[:10]
    texts = ["\n".join(t) for t in (lines, near, lines, some)] + ["", None, "one line"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, drop_depleted=True).collect()}
    assert kept.keys() == {0, 3, 4, 5, 6} and kept[0] == texts[0] and kept[3] == "\n".join(some[:20])
    assert len(line_dedup.dedup_lines(docs).collect()) == 7


@pytest.mark.parametrize("places", [[], [0], [2], [0, 1, 2], [1], [0, 2]])
def test_lines_are_taken_out(spark, places):
    df = spark.createDataFrame([("a\n\nc", places), ("a\n\nc", None)], "text string, places array<int>")
    got = [r[0] for r in df.select(texts.without_lines(F.col("text"), F.col("places"))).collect()]
    assert got == ["\n".join(x for i, x in enumerate(["a", "", "c"]) if i not in places), "a\n\nc"]


def test_texts_of_very_many_lines(spark):
    """Two equal documents of many lines: every line of the second one goes, in time that follows the lines."""
    rng = random.Random(23)

    def seconds(n):
        text = "\n".join(f"{prose(rng, 3)} {i}" for i in range(n))
        docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
        start = time.perf_counter()
        rows = {r["doc_id"]: r for r in line_dedup.line_report(docs).collect()}
        assert rows[1]["n_removed_lines"] == 0 and rows[2]["n_removed_lines"] == n
        return time.perf_counter() - start

    seconds(2000)
    assert seconds(80_000) < 16 * max(seconds(10_000), 0.5)


def test_passages_of_one_document(spark):
    rng = random.Random(17)
    line, passage = prose(rng, 10), [prose(rng, 30) for _ in range(2)]
    got = cleaned(spark, ["\n".join([line] * 40), "\n".join([*passage, prose(rng, 9), *passage])])
    assert got[0] == [line] * 5 and len(got[1]) == 3 and got[1][:2] == passage


def test_boundaries_do_not_shift(spark):
    rng = random.Random(7)
    body = [prose(rng, 10) for _ in range(80)]
    docs = spark.createDataFrame([(1, "\n".join(body)), (2, "\n".join([prose(rng, 10)] * 3 + body))], "doc_id long, text string")
    lasts = {i: {r["last"] for r in line_dedup.chunks(docs).filter(f"doc_id = {i}").collect()} for i in (1, 2)}
    assert len(lasts[1] & {x - 3 for x in lasts[2]}) >= len(lasts[1]) - 2


def test_chunks_join_to_the_text(spark):
    rng = random.Random(8)
    texts = ["", "\n", "a", "\n\n", doc(rng, 9), "a\n" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = line_dedup.chunks(docs).orderBy("doc_id", "first").collect()
    for i, text in enumerate(texts):
        assert "\n".join(r["chunk"] for r in found if r["doc_id"] == i) == text


def repeat_words(text: str) -> int:
    words = text.split()
    places: dict = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({i + k for found in places.values() if len(found) > 1 for i in found for k in range(3)})


def test_repeated_windows_on_every_path(spark, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(rng.choices("abcd", k=rng.randint(0, 40))) for _ in range(200)] + ["é é é é", "a b c a b c"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    want = {i: repeat_words(t) for i, t in enumerate(texts)}
    for bits in (22, 58, 3):  # hashes that tell windows apart, hashes of six bits, and too few places
        monkeypatch.setattr(quality, "PLACE_BITS", bits)
        got = {r["doc_id"]: r["n_repeat_words"] for r in quality.base_counts(docs, "source").collect()}
        assert got == want


def test_boilerplate_of_one_host(spark):
    rng = random.Random(10)
    banner = prose(rng, 45)
    rows = [(i, prose(rng, 60) + "\n  " + banner.upper(), "loud") for i in range(14)]
    rows += [(20 + i, prose(rng, 20) + "\n" + banner, "loud") for i in range(3)]
    rows += [(40 + i, prose(rng, 20) + "\n" + banner, "quiet") for i in range(9)]
    rows += [(60 + i, "same " + banner, "copies") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(docs).collect() if not r["base_failed"]}
    assert all(kept[i] for i in range(14)) and not any(kept[20 + i] for i in range(3)) and all(kept[40 + i] for i in range(9))
    out = {r["doc_id"]: r["text"] for r in quality.apply_quality(docs).collect()}
    assert all(banner.upper() not in out[i] for i in range(14)) and banner in out[40] and not {20, 21, 22} & out.keys()


def test_the_limit_does_not_grow_with_the_host(spark):
    rng = random.Random(20)
    banner = prose(rng, 45)
    rows = [(i, prose(rng, 20) + "\n" + banner, host) for host in ("hot", "cold") for i in range(11)]
    rows += [(100 + i, f"text {i}", "hot") for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    assert quality.quality_report(docs).filter("doc_id < 100").filter("kept or n_removed_lines <> 1").count() == 0
    assert quality.apply_quality(docs).filter("doc_id < 100").count() == 0


def test_line_weights_are_those_of_each_line_and_take_time_in_proportion(spark):
    texts = ["a  b\tc\r\n \td\x0b e", "漢字 かな\n文a字b 𠀀𠀁\n\t", "ไทย abc\t\tdef\n \n\tx", "é ü x\n y z", "😀 漢 \x0c\n", ""]
    weights = spark.createDataFrame([(t,) for t in texts], "text string").select(line_dedup.line_weights(F.col("text")).alias("w"))
    spaced = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in line_dedup.UNSPACED_BLOCKS) + "]")

    def plain(line):
        return 2 * len(re.findall(r"[^\x20\x09-\x0D]+", spaced.sub(" ", line))) + len(spaced.findall(line))

    assert [r["w"] for r in weights.collect()] == [[plain(line) for line in t.split("\n")] for t in texts]

    # looking for other scripts once for every line went through this text 40,000 times
    long = spark.range(1).select(F.expr("array_join(transform(sequence(1, 40000), i -> concat('words of line ', i)), '\n')").alias("text"))
    begun = time.monotonic()
    assert long.select(line_dedup.line_weights(F.col("text")).alias("w")).selectExpr("sum(aggregate(w, 0, (a, x) -> a + x))").first()[0] == 8 * 40000
    assert time.monotonic() - begun < 20


def test_hashes_of_lines_are_joined_as_they_are_kept(spark):
    """A line stands in many windows; its hash was turned into text anew for each of them."""
    docs = spark.createDataFrame([(1, "one two\nthree"), (2, "caf\u00e9 \u0e01\u0e02\u0e03")], "doc_id long, text string")
    weighed = line_dedup.weighed_lines(docs)
    assert weighed.schema["hashes"].dataType.simpleString() == "array<string>"
    rows = {r["doc_id"]: r for r in weighed.collect()}
    assert rows[1]["hashes"] == [hashlib.md5(line).hexdigest() for line in (b"one two", b"three")]
    assert [w["weight"] for w in rows[1]["spoken"]] == [4, 2] and [w["weight"] for w in rows[2]["spoken"]] == [5]
