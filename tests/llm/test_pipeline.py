"""The pipeline's stages, each judged on its own input."""

import base64
import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken

import corpus_pipeline
from obsloom.llm import line_dedup, quality
from obsloom.session import work_path
from tables import clashing, awkward, empty, linked, shingles

NAMES = [name for name, _ in corpus_pipeline.STAGES]


def stage_results(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = work_path(spark, name)
        stage(spark, results[-1], sf_dir).write.parquet(path)
        results.append(spark.read.parquet(path))
    return results


def test_stages(spark, sf_dir):
    docs, good, lines, apart, mixed, encoded = stage_results(spark, sf_dir)
    assert len({tuple(x.columns) for x in (docs, good, lines, apart, mixed)}) == 1

    report = {r["doc_id"]: r["kept"] for r in quality.quality_report(docs).collect()}
    assert {r["doc_id"] for r in good.collect()} == {i for i, kept in report.items() if kept}

    before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (good, lines))
    whole = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(good).collect()}
    words = lambda text: len(text.split())
    assert after == {i: t for i, t in whole.items() if words(before[i]) - words(t) <= 0.5 * words(before[i])}
    assert before.keys() == whole.keys() and all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    for doc_id, text in after.items():
        assert not Counter(text.split("\n")) - Counter(before[doc_id].split("\n")) or text == ""

    sets = {i: shingles(t, 5) for i, t in after.items()}
    kept = {r["doc_id"] for r in apart.collect()}
    assert not any(linked(sets[a], sets[b], 80) for a in kept for b in kept if a < b)
    for gone in sets.keys() - kept:
        assert any(linked(sets[gone], sets[other], 80) for other in sets if other != gone)

    sizes, taken = defaultdict(int), defaultdict(int)
    for r in apart.collect():
        sizes[r["source"]] += len(r["text"].split())
    counts = Counter(r["doc_id"] for r in mixed.collect())
    longest = defaultdict(int)
    for r in mixed.collect():
        taken[r["source"]] += len(r["text"].split())
        longest[r["source"]] = max(longest[r["source"]], len(r["text"].split()))
    assert max(counts.values()) <= 2 and counts.keys() <= kept
    total = sum(sizes.values())
    assert abs(sum(taken.values()) - 1.5 * total) <= sum(longest.values())
    assert all(taken[s] <= 2 * sizes[s] for s in sizes)

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = sorted((r["doc_id"], r["text"]) for r in mixed.collect())
    got = sorted((r["doc_id"], r["ids"]) for r in encoded.collect())
    assert got == sorted((i, reference.encode_ordinary(t)) for i, t in texts)


def test_awkward_tables_pass_every_stage(spark, sf_dir):
    docs = clashing(awkward(spark))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert name == NAMES[-1] or docs.columns == columns
    assert docs.count() > 0
    nothing = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, sf_dir)
    assert nothing.count() == 0


def test_the_last_stage_decodes_what_it_encodes(spark, sf_dir):
    rows = {i: t or "" for i, t in enumerate(["plain text", "\u00e9 \u6f22\U0001f642 x", "", None])}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect():
        text = rows[r["doc_id"]]
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert len(r["offsets"]) == r["n_tokens"] + 1 and r["offsets"][-1] == len(text)
