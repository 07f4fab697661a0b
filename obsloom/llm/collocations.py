"""Phrase collocations by partitioned mining: locally frequent phrases of each shard, united, then counted exactly.

1.  The documents fall into shards of a bounded number of characters, which are kept as word numbers and their words.
2.  A phrase that occurs ``support`` times occurs in some shard at least as often as the shard's share of all
    characters asks for. So each shard is mined at that lowered support and the locally frequent phrases are united.
    With very many shards the lowered support comes near 1 and holds back little; therefore a shard hands on all of
    its phrases, as sorted numbers of 40 bits with their counts and whether they are locally frequent, a few bytes
    each. Where these are united, a phrase is dropped if it is locally frequent nowhere, or if the counts of its number
    add up to less than ``support``. What is left goes into a bitmap of fixed size, every shard counts what the
    bitmap lets through, and these counts are added up by the phrase itself. Phrases that share a number or a place in
    the bitmap are counted like the rest, so neither decides a result. These counts travel packed as well, by range.
3.  This is done for one size after the other. A phrase is looked at only where both phrases without one of its end
    words are frequent in the whole table.
4.  Cuts are scored by joins of the counted phrases with their own parts.

Inside a shard phrases meet by hash, and equal hashes are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsloom.llm.byte_bpe import slices
from obsloom.llm.shingles import mix
from obsloom.llm.texts import pick, stored, whole_text
from obsloom.session import work_path

#: Characters of a shard, and shards of a small table at least.
SHARD, LEAST_SHARDS = 1 << 25, 8
#: Bits of a bitmap of phrases (8 MB); each phrase sets two of them. It travels in so many slices.
FILTER_BITS, SLICES = 26, 16
#: Characters whose words are told apart at once.
TEXTS = 1 << 22
#: Bits of a phrase's number, and ranges of numbers that are united on their own: so many for each shard, within limits.
KEY_BITS, RANGES, RANGE_LIMITS = 40, 4, (8, 1 << 14)
#: Between two pieces.
BREAK = -1
#: Parts of a language that are ordered on their own before their best phrases meet.
SALTS = 64
UNKNOWN = "und"

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_KIND = np.zeros(256, dtype=np.uint8)  # 0 belongs to a word, 1 separates words, 2 separates pieces as well
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Rules:
    """Which phrases are collocations: their words, how often they occur, when a longer one replaces them, how many are named."""

    most_words: int = 5
    support: int = 100
    percent: int = 100
    top: int = 2000


def tokens(texts: list[str]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(word numbers, the words, piece numbers): the words of all texts in order; pieces end with their text."""
    raw = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_LOWER)
    codes = np.frombuffer(raw, dtype=np.uint8)
    kind = _KIND[codes]
    inside = kind == 0
    edge = np.zeros(1, dtype=bool)
    starts = np.flatnonzero(inside & ~np.concatenate([edge, inside[:-1]]))
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], edge])) + 1
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    offsets = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(ends - starts)])
    data = codes[inside]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    named = words.dictionary_encode()
    return named.indices.to_numpy(zero_copy_only=False).astype(np.int32), named.dictionary, piece


@dataclass
class Words:
    """The words of one language in a shard: numbers in order with ``BREAK`` after every piece, and what they stand for."""

    numbers: list[np.ndarray]
    known: dict[bytes, int]

    def add(self, texts: list[str]) -> None:
        ids, vocabulary, piece = tokens(texts)
        if not len(ids):
            return
        own = np.array([self.known.setdefault(w, len(self.known)) for w in vocabulary.to_pylist()], dtype=np.int32)[ids]
        ends = np.flatnonzero(np.concatenate([piece[1:] != piece[:-1], [True]])) + 1
        self.numbers.append(np.insert(own, ends, BREAK))

    def row(self, lang: str, chars: int) -> tuple[str, int, int, bytes, bytes]:
        ids = np.concatenate(self.numbers) if self.numbers else np.zeros(0, dtype=np.int32)
        planes = np.ascontiguousarray(ids).view(np.uint8).reshape(-1, 4).T.tobytes()
        return lang, chars, int((ids != BREAK).sum()), zstandard.compress(planes, 1), zstandard.compress(b" ".join(self.known), 1)


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(lang, chars, n, ids, words): shards of ``size`` to twice ``size`` characters, or of what a task has in all."""
    shard: dict[str, Words] = {}
    waiting: dict[str, list[str]] = {}
    chars = held = 0

    def settle() -> None:
        nonlocal held
        for lang, texts in waiting.items():
            shard.setdefault(lang, Words([], {})).add(texts)
        waiting.clear()
        held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        settle()
        for lang, words in shard.items():
            values = words.row(lang, chars)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["lang", "chars", "n", "ids", "words"])
        shard.clear()

    for batch in slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            waiting.setdefault(lang, []).append(text)
            chars, held = chars + len(text), held + len(text)
            if held >= min(TEXTS, size):
                settle()
            if chars >= size:
                yield from rows()
                chars = 0
    if waiting or shard:
        yield from rows()


def unpacked(ids: bytes, words: bytes) -> tuple[np.ndarray, list[bytes]]:
    planes = np.frombuffer(zstandard.decompress(ids), dtype=np.uint8)
    vocabulary = zstandard.decompress(words)
    return planes.reshape(4, -1).T.copy().view(np.int32)[:, 0], vocabulary.split(b" ") if vocabulary else []


def bits_of(hashes: np.ndarray, width: int) -> list[np.ndarray]:
    """The two places of each phrase, from its number, in a bitmap of 2**width bits."""
    spread = mix(hashes >> _U(64 - KEY_BITS))
    return [(spread & _U((1 << width) - 1)).astype(np.int64), (spread >> _U(64 - width)).astype(np.int64)]


def packed(hashes: np.ndarray, count: np.ndarray, often: np.ndarray, support: int) -> bytes:
    """Sorted hashes as numbers, counts up to ``support``, and marks, compressed."""
    gaps = np.diff(hashes >> _U(64 - KEY_BITS), prepend=_U(0))
    marked = np.minimum(count, support).astype(np.uint32) << 1 | often.astype(np.uint32)
    planes = [c.view(np.uint8).reshape(len(hashes), -1).T for c in (gaps, marked)]
    return zstandard.compress(np.concatenate(planes).tobytes(), 1)


def counts_of(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``packed`` was given: numbers as hashes whose other bits are 0, counts, marks."""
    planes = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(12, -1)
    gaps, marked = planes[:8].T.copy().view(np.uint64)[:, 0], planes[8:].T.copy().view(np.uint32)[:, 0]
    return np.cumsum(gaps, dtype=np.uint64) << _U(64 - KEY_BITS), (marked >> 1).astype(np.int64), (marked & 1).astype(bool)


def may_be_frequent(blobs: Iterable[bytes], support: int) -> np.ndarray:
    """Numbers, as hashes, that are marked somewhere and whose counts add up to ``support``."""
    hashes, counts, marks = (np.concatenate(c) for c in zip(*map(counts_of, blobs)))
    order = np.argsort(hashes, kind="stable")
    hashes, counts, marks = hashes[order], counts[order], marks[order]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    good = (np.add.reduceat(counts, starts) >= support) & np.logical_or.reduceat(marks, starts)
    return hashes[starts][good]


def tallied(hashes: np.ndarray, count: np.ndarray, phrases: list[bytes]) -> bytes:
    """Phrases with their hashes and counts, compressed; no phrase holds a line end."""
    planes = np.stack([hashes.view(np.int64), count.astype(np.int64)]).view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1)
    return zstandard.compress(len(phrases).to_bytes(4, "little") + planes.tobytes() + b"\n".join(phrases), 1)


def sums_of(blobs: Iterable[bytes], support: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(phrase, hash, n) of the phrases whose counts in all blobs add up to ``support``, compared by their bytes."""
    phrases, numbers = [], []
    for blob in blobs:
        raw = zstandard.decompress(blob)
        n = int.from_bytes(raw[:4], "little")
        planes = np.frombuffer(raw, dtype=np.uint8, count=16 * n, offset=4).reshape(2, 8, n)
        numbers.append(planes.transpose(0, 2, 1).copy().view(np.int64)[:, :, 0])
        phrases += raw[4 + 16 * n :].split(b"\n")
    hashes, count = np.concatenate(numbers, axis=1)
    named = pa.array(phrases, pa.binary()).dictionary_encode()
    code = named.indices.to_numpy()
    total, own = np.zeros(len(named.dictionary), dtype=np.int64), np.zeros(len(named.dictionary), dtype=np.int64)
    np.add.at(total, code, count)
    own[code] = hashes
    often = np.flatnonzero(total >= support)
    return named.dictionary.take(pa.array(often)), own[often], total[often]


def among(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Which phrases the bitmap, bytes of 8 bits, may hold."""
    width = 2 + len(bitmap).bit_length()
    hit = np.ones(len(hashes), dtype=bool)
    for place in bits_of(hashes, width):
        hit &= (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return hit


def phrases_of(ids: np.ndarray, word_hash: np.ndarray, size: int, parts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, count, first place) of the phrases of ``size`` words whose two parts of one word less ``parts`` may hold."""
    hashes = word_hash[ids]  # BREAK stands for any word here; such places are left out
    inside = ids != BREAK
    for k in range(1, size - 1):
        hashes = mix(hashes[:-1] * _BASE + word_hash[ids[k:]])
        inside = inside[:-1] & (ids[k:] != BREAK)
    if size > 1:
        live = np.zeros(len(hashes), dtype=bool)
        at = np.flatnonzero(inside)
        live[at] = among(hashes[at], parts) if parts is not None else True
        place = np.flatnonzero(live[:-1] & live[1:] & (ids[size - 1 :] != BREAK))
        found = mix(hashes[place] * _BASE + word_hash[ids[place + size - 1]])
    else:
        place = np.flatnonzero(inside)
        found = hashes[place]
    order = np.argsort(found, kind="stable")
    found, place = found[order], place[order]
    words = [ids[place + k] for k in range(size)]
    new = np.concatenate([[True], found[1:] != found[:-1]]) if len(found) else np.zeros(0, dtype=bool)
    if any((~new[1:] & (w[1:] != w[:-1])).any() for w in words):  # different phrases of one hash lie mixed
        order = np.lexsort([*words, found])
        found, place, words = found[order], place[order], [w[order] for w in words]
        new[1:] = np.any([w[1:] != w[:-1] for w in words], axis=0)
    starts = np.flatnonzero(new)
    return found[starts], np.diff(np.concatenate([starts, [len(found)]])), place[starts]


def _mined(batches: Iterator[pa.RecordBatch], size: int, parts: np.ndarray | None) -> Iterator[tuple]:
    """Of each shard: language, characters, word numbers, words, and its phrases of ``size`` words as ``phrases_of`` gives them."""
    for batch in batches:
        for lang, chars, packed_ids, packed_words in zip(*[batch.column(c) for c in ("lang", "chars", "ids", "words")]):
            lang = lang.as_py()
            ids, words = unpacked(packed_ids.as_py(), packed_words.as_py())
            if not len(ids):
                continue
            seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
            word_hash = np.fromiter((xxhash.xxh64_intdigest(w, seed=seed) for w in words), dtype=np.uint64, count=len(words))
            yield lang, chars.as_py(), ids, words, *phrases_of(ids, word_hash, size, parts)


def _slices(hashes: Iterable[np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
    """The bitmap of the phrases in compressed slices (slice, bits)."""
    bitmap = np.zeros(1 << (width - 3), dtype=np.uint8)
    for some in hashes:
        for place in bits_of(some, width):
            np.bitwise_or.at(bitmap, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
    for i, part in enumerate(bitmap.reshape(min(SLICES, len(bitmap)), -1)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([zstandard.compress(part.tobytes(), 1)])], names=["slice", "bits"])


def united(parts: DataFrame, width: int) -> np.ndarray:
    """The union of bitmaps that came in slices; a slice of all of them meets in one task, and the bitmap on the driver."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, bits in zip(batch.column("slice").to_pylist(), batch.column("bits")):
                part = np.frombuffer(zstandard.decompress(bits.as_py()), dtype=np.uint8)
                whole[i] = whole[i] | part if i in whole else part
        for i, part in whole.items():
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([zstandard.compress(part.tobytes(), 1)])], names=["slice", "bits"])

    bitmap = np.zeros(1 << (width - 3), dtype=np.uint8)
    rows = bitmap.reshape(min(SLICES, len(bitmap)), -1)
    for row in parts.repartition(SLICES, "slice").mapInArrow(unite, "slice long, bits binary").collect():
        rows[row["slice"]] = np.frombuffer(zstandard.decompress(bytes(row["bits"])), dtype=np.uint8)
    return bitmap


def frequent_phrases(docs: DataFrame, rules: Rules = Rules(), shard: int = SHARD, width: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, n) of all phrases, single words too, with at least ``support`` occurrences in their
    language, and (lang, n) with the number of all words of each language.
    """
    rows = pick(docs, "text", "lang").select(whole_text().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    few = rows.coalesce(max(LEAST_SHARDS, -(-chars // shard)))
    path = work_path(docs.sparkSession, "shards")
    # a group of rows for each shard or two, so that no reader holds many of them
    few.mapInArrow(lambda batches: _shards(batches, shard), "lang string, chars long, n long, ids binary, words binary").write.option(
        "parquet.block.size", 1 << 23
    ).option("compression", "none").parquet(path)
    shards = docs.sparkSession.read.parquet(path)
    context = docs.sparkSession.sparkContext
    ranges = min(max(RANGES * -(-chars // shard), RANGE_LIMITS[0]), RANGE_LIMITS[1])
    tables, parts = [], None
    for size in range(1, rules.most_words + 1):
        known = context.broadcast(parts)

        def local(batches: Iterator[pa.RecordBatch], size: int = size, known=known) -> Iterator[pa.RecordBatch]:
            step = _U((1 << 64) // ranges + 1)
            for _, of_shard, _, _, hashes, count, _ in _mined(batches, size, known.value):
                if not len(hashes):
                    continue
                often = count >= -(-rules.support * of_shard // max(1, chars))
                here = (hashes // step).astype(np.int64)
                starts = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]])).tolist()
                blobs = [packed(hashes[i:j], count[i:j], often[i:j], rules.support) for i, j in zip(starts, [*starts[1:], len(here)])]
                yield pa.RecordBatch.from_arrays([pa.array(here[starts]), pa.array(blobs, pa.binary())], names=["range", "phrases"])

        def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def frequent() -> Iterator[np.ndarray]:
                held: dict[int, list[bytes]] = {}
                for batch in batches:
                    for number, blob in zip(batch.column("range").to_pylist(), batch.column("phrases").to_pylist()):
                        held.setdefault(number, []).append(blob)
                while held:
                    yield may_be_frequent(held.popitem()[1], rules.support)

            return _slices(frequent(), width)

        mined = shards.mapInArrow(local, "range long, phrases binary").repartition(ranges, "range")
        candidates = context.broadcast(united(mined.mapInArrow(unite, "slice long, bits binary"), width))

        def counted(batches: Iterator[pa.RecordBatch], size: int = size, known=known, candidates=candidates) -> Iterator[pa.RecordBatch]:
            step = _U((1 << 64) // ranges + 1)
            for lang, _, ids, words, hashes, count, place in _mined(batches, size, known.value):
                chosen = np.flatnonzero(among(hashes, candidates.value))
                if not len(chosen):
                    continue
                vocabulary = pa.array(words, pa.binary())
                spelled = [vocabulary.take(pa.array(ids[place[chosen] + k])) for k in range(size)]
                phrase = pc.binary_join_element_wise(*spelled, pa.scalar(b" ", pa.binary())).to_pylist() if size > 1 else spelled[0].to_pylist()
                hashes, count, here = hashes[chosen], count[chosen], (hashes[chosen] // step).astype(np.int64)
                starts = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]])).tolist()
                blobs = [tallied(hashes[i:j], count[i:j], phrase[i:j]) for i, j in zip(starts, [*starts[1:], len(here)])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(here[starts]), pa.array([lang] * len(starts), pa.string()), pa.array(blobs, pa.binary())], names=["range", "lang", "phrases"]
                )

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, str], list[bytes]] = {}
            for batch in batches:
                for number, lang, blob in zip(*[batch.column(c).to_pylist() for c in ("range", "lang", "phrases")]):
                    held.setdefault((number, lang), []).append(blob)
            while held:
                (_, lang), blobs = held.popitem()
                phrase, hashes, n = sums_of(blobs, rules.support)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), phrase.cast(pa.string()), pa.array(hashes), pa.array(n)], names=["lang", "phrase", "hash", "n"]
                )

        dealt = shards.mapInArrow(counted, "range long, lang string, phrases binary").repartition(ranges, "range")
        found = dealt.mapInArrow(added, "lang string, phrase string, hash long, n long")
        tables.append(stored(found.withColumn("n_words", F.lit(size)), "phrases"))
        if tables[-1].isEmpty():
            break
        if size < rules.most_words:
            hashed = tables[-1].select("hash")
            parts = united(hashed.mapInArrow(lambda batches: _slices((b.column("hash").to_numpy().view(np.uint64) for b in batches), width), "slice long, bits binary"), width)
    phrases = reduce(DataFrame.unionByName, tables).select("lang", "phrase", "n_words", "n")
    return phrases, shards.groupBy("lang").agg(F.sum("n").alias("n"))


def _parts(words: Column, start: int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, F.lit(start), length), " ")


def collocations(docs: DataFrame, rules: Rules = Rules(), shard: int = SHARD, width: int = FILTER_BITS) -> DataFrame:
    """Best phrases of each language (``docs``: text, lang): lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to ``most_words`` words with ``support`` occurrences, a; cutting one after its first
    words gives l and r, the occurrences of both parts, and floor(1000 * a * n / (l * r)) with n words of the
    language; the lowest counts, ties to the shortest first part. Candidates inside a longer one with
    ``percent`` of their occurrences are dropped. Ties in rank go by a, then by the phrase's bytes.

    Null texts count as empty, a null language as ``und``. Repeated rows count as often as they are there. A table
    without a frequent phrase, an empty one among them, gives no rows; other columns are not looked at.
    """
    counted, totals = frequent_phrases(docs, rules, shard, width)
    totals = totals.withColumnRenamed("n", "all_n")
    parts = counted.select("lang", "phrase", "n")
    phrases = counted.filter("n_words > 1").withColumn("words", F.split("phrase", " "))

    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    rest = F.array_join(F.expr("slice(words, k + 1, size(words))"), " ")
    cuts = stored(cuts.select("lang", "phrase", "a", "k", _parts(F.col("words"), 1, F.col("k")).alias("left_part"), rest.alias("right_part")), "cuts")
    left, right = parts.toDF("lang", "left_part", "l"), parts.toDF("lang", "right_part", "r")
    halved = stored(cuts.join(left, ["lang", "left_part"]).drop("left_part"), "half-cuts")
    cut = halved.join(right, ["lang", "right_part"]).join(totals, "lang")
    # n and a stay below 10**17, so the products fit into 38 digits
    whole = {c: F.col(c).cast("decimal(17,0)") for c in ("a", "all_n", "l", "r")}
    cut = cut.withColumn("above", F.lit(1000).cast("decimal(4,0)") * whole["a"] * whole["all_n"]).withColumn("below", whole["l"] * whole["r"])
    lowest = F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut")
    scored = cut.groupBy("lang", "phrase", "a", F.col("all_n").alias("n")).agg(lowest)

    spans = F.array(*[
        F.struct(F.lit(start + 1).alias("start"), F.lit(size).alias("size"))
        for size in range(2, rules.most_words) for start in range(rules.most_words - size + 1)
    ]) if rules.most_words > 2 else F.array().cast("array<struct<start:int,size:int>>")
    inner = phrases.withColumn("span", F.explode(F.filter(spans, lambda s: (s["start"] + s["size"] - 1 <= F.col("n_words")) & (s["size"] < F.col("n_words")))))
    inner = inner.select("lang", F.array_join(F.expr("slice(words, span.start, span.size)"), " ").alias("phrase"), F.col("n").alias("outer_n"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("outer_n").alias("outer_n"))
    stays = scored.join(covered, ["lang", "phrase"], "left").filter(F.expr(f"outer_n is null or 100L * outer_n < {rules.percent}L * a"))
    best = stays.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    order = [F.desc("score"), F.desc("a"), "phrase"]
    # two steps, so that no task orders a whole language
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    leading = salted.withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("at") <= rules.top)
    ranked = leading.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= rules.top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
