"""Near duplicates by SimHash fingerprints, compared as bit planes.

Equal fingerprints are one class, and only classes are compared. Fingerprints that differ in few bits agree in one of
a few more parts of their bits, so they meet in the group of that part's value. A group that is larger than
``GROUP`` is not compared: its members agree in the part already, and meet again by parts of the bits that are left,
which splits hot groups without losing a link. Groups are compared many at once, sorted one behind the other: the
rows are stored as 64 bit planes, a row and the row ``shift`` places behind it are compared by exclusive or of
planes, carry-save counters of a few bits add up the differences of 64 pairs in one operation, and a block of 64
pairs is abandoned once all of them differ in too many bits. Of the links of a group only those that connect it go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.llm.byte_bpe import slices
from obsloom.llm.components import components
from obsloom.llm.texts import pick, shuffle_partitions, stored, whole_text

#: Seed of the shingles' hashes.
SEED = 42
#: Members of a group that is compared, and the bits in which so many can differ.
GROUP, LEAST_BITS = 4096, 12
#: Rows that are compared at once, planes between two looks at what is left, and pairs that wait to be connected.
ROWS, PLANES, PAIRS = 1 << 18, 8, 1 << 20
#: Shingles that are hashed at once.
PART = 1 << 15

_U = np.uint64


def fingerprint(text: str, words: int = 3) -> int:
    """Bit by bit what more than half of the shingles' XXH64 have; 0 without words.

    Shingles are runs of ``words`` words, repeated ones count again; a text of fewer words is one shingle.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    n = min(words, len(found))
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    raw = b" ".join(found)
    begin, end = starts[: len(found) - n + 1], ends[n - 1 :]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(begin), PART):
        part = zip(begin[i : i + PART].tolist(), end[i : i + PART].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(raw[a:b], SEED) for a, b in part], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(begin), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of every row of ``docs`` (doc_id, text), the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def planes_of(fps: np.ndarray) -> np.ndarray:
    """The bits of the fingerprints as 64 planes; bit i of a plane's word w belongs to fingerprint 64 * w + i; the last word is empty."""
    padded = np.zeros((len(fps) // 64 + 2) * 64, dtype="<u8")
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def behind(planes: np.ndarray, words: np.ndarray, shift: int) -> np.ndarray:
    """The named words of the planes of the rows ``shift`` places further on; ``planes`` ends with an empty word."""
    whole, rest = divmod(shift, 64)
    last = planes.shape[1] - 1
    found = planes[:, np.minimum(words + whole, last)]
    return (found >> _U(rest)) | (planes[:, np.minimum(words + whole + 1, last)] << _U(64 - rest)) if rest else found


def near_pairs(fps: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of rows of one group with at most ``radius`` differing bits; the rows of a group follow each other."""
    if len(fps) < 2:
        return
    planes = planes_of(fps)
    sizes = np.diff(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])))
    for shift in range(1, int(sizes.max())):
        same = np.zeros(planes.shape[1] * 64, dtype=bool)
        same[: len(group) - shift] = group[shift:] == group[:-shift]
        together = np.packbits(same, bitorder="little").view("<u8")
        words = np.flatnonzero(together)
        one, other, left = planes[:, words], behind(planes, words, shift), ~together[words]
        counters = [np.zeros(len(words), dtype=np.uint64) for _ in range(max(1, radius.bit_length()))]
        for start in range(0, 64, PLANES):
            for b in range(start, start + PLANES):
                carry = one[b] ^ other[b]
                for j, counter in enumerate(counters):
                    counters[j], carry = counter ^ carry, counter & carry
                left = left | carry | above(counters, radius)
            open_words = np.flatnonzero(~left)
            if len(open_words) < len(words):  # abandoned blocks go
                words, left, counters = words[open_words], left[open_words], [c[open_words] for c in counters]
                one, other = one[:, open_words], other[:, open_words]
            if not len(words):
                break
        if len(words):
            hits = np.unpackbits((~left).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, bit = np.nonzero(hits)
            first = words[at] * 64 + bit
            yield first, first + shift


def above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """For 64 pairs at once whether their vertical counters exceed ``radius``."""
    more, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for j in reversed(range(len(counters))):
        if radius >> j & 1:
            equal &= counters[j]
        else:
            more |= equal & counters[j]
            equal &= ~counters[j]
    return more


def connected(label: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """``label``, a smaller place of the same set for every place, after the links (one, other) are added."""
    while True:
        a, b = label[one], label[other]
        apart = a != b
        if not apart.any():
            return label
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (further := label[label]).tobytes() != label.tobytes():
            label = further


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that connect each group of rows (mask, part, fp), which come sorted by group."""

    def compared(mask: np.ndarray, part: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = np.cumsum(np.concatenate([[False], (mask[1:] != mask[:-1]) | (part[1:] != part[:-1])]))
        label, waiting, n = np.arange(len(fp)), [], 0
        for pair in near_pairs(fp.view(np.uint64), group, radius):
            waiting.append(pair)
            n += len(pair[0])
            if n > PAIRS:
                label, waiting, n = connected(label, *map(np.concatenate, zip(*waiting))), [], 0
        if waiting:
            label = connected(label, *map(np.concatenate, zip(*waiting)))
        moved = np.flatnonzero(label != np.arange(len(fp)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[label[moved]])], names=["a", "b"])

    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy() for c in ("mask", "part", "fp")))
        n += batch.num_rows
        if n < ROWS:
            continue
        mask, part, fp = (np.concatenate(c) for c in zip(*held))
        last = np.flatnonzero((mask != mask[-1]) | (part != part[-1]))
        whole = int(last[-1]) + 1 if len(last) else 0  # the last group may go on
        yield from compared(mask[:whole], part[:whole], fp[:whole])
        held, n = [(mask[whole:], part[whole:], fp[whole:])], len(fp) - whole
    if n:
        yield from compared(*(np.concatenate(c) for c in zip(*held)))


def finer(mask: int, radius: int) -> list[int]:
    """``mask`` with each of ``radius + 1`` parts of the bits that it lacks; two of its members that are linked agree in one."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * i // (radius + 1) for i in range(radius + 2)]
    return [mask | sum(1 << b for b in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_links(fps: DataFrame, radius: int = 2, group: int = GROUP) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` that connect all within ``radius`` bits of each other.

    A level deals the members of groups that are too large to groups of a finer mask; after a handful of levels so few
    bits are left that a group, whose members differ, cannot be too large.
    """
    if not 0 <= radius < LEAST_BITS:
        raise ValueError(f"the radius is from 0 to {LEAST_BITS - 1}")
    masks = finer(0, radius)
    rows = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    links = None
    while True:
        rows = stored(rows.withColumn("part", F.col("fp").bitwiseAND(F.col("mask"))), "parts")
        most = 1 << max(64 - m.bit_count() for m in masks)
        large = rows.groupBy("mask", "part").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > max(group, min(most, 1 << LEAST_BITS)))
        large = stored(large.select("mask", "part"), "large-parts")
        done = large.isEmpty()
        met = rows if done else rows.join(large, ["mask", "part"], "left_anti")
        dealt = met.repartition(shuffle_partitions(fps), "mask", "part").sortWithinPartitions("mask", "part", "fp")
        found = dealt.select("mask", "part", "fp").mapInArrow(lambda batches: _links(batches, radius), "a long, b long")
        links = found if links is None else links.unionByName(found)
        if done:
            return links
        finer_of = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in finer(m, radius)]))])
        again = rows.join(large, ["mask", "part"], "left_semi").select("fp", F.explode(finer_of[F.col("mask")]).alias("mask"))
        rows, masks = again.distinct(), sorted({f for m in masks for f in finer(m, radius)})


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def simhash_components(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hexadecimal digits), component_id.

    Fingerprints are linked when at most ``radius`` of their 64 bits differ; ``component_id`` is the smallest doc_id
    that links reach, its own included. Null and empty texts and those of white space have fingerprint 0, which
    is linked like any other. Repeated rows get the same component; null identifiers count only where a component has
    no other, which then has none. An empty table gives no rows; other columns are not looked at.
    """
    documents = stored(fingerprints(docs, words), "fingerprints")
    classes = stored(documents.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    labels = components(near_links(classes.select("fp"), radius))
    names = classes.join(labels.withColumnRenamed("id", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = stored(names.groupBy("label").agg(F.min("least").alias("component_id")), "component-least")
    found = stored(names.join(least, "label").select("fp", "component_id"), "fingerprint-components")
    return documents.join(found, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")
