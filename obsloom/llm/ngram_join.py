"""Links between documents with nearly the same set of word shingles, and their components.

Jaccard similarity, exact. Equal sets are one class, and only classes are compared.

1.  A set's shingles are dealt by hash into a few parts, more than two linked sets can differ in; so two
    linked sets agree in one part at least. Classes that share no part with another class are done.
2.  For the others the shingles are put in order of frequency, rarest first. Two linked sets share one
    of their first shingles, so an index list is kept for those alone. An entry holds the size of its set
    and the position of the shingle.
3.  Lists are skipped by position: the shingles before a first common one are in one of the two sets only, so
    blocks of positions whose sum exceeds the difference that links allow are never joined.
4.  The first entry of a list, the one with the fewest rarer shingles, is its leader. Every entry is compared
    with it first. A set that is linked to a leader takes over the leader's answers; what is left to compare
    are pairs of entries in different components.

Sets are named by 128 bits, shingles by 64; pairs are compared by the whole sets, rebuilt from the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.llm.byte_bpe import slices
from obsloom.llm.components import components
from obsloom.llm.shingles import identity, mix, shingle_set
from obsloom.llm.texts import Sealed, pick, shuffle_partitions, stored, text_mark, whole_text

#: Blocks of positions in an index list.
BLOCKS = 4
#: Bits of the filter that spares texts of settled classes a shuffle; the join after it is exact.
FILTER_BITS = 24
#: Signatures that a task holds before it hands them on, and sets of one shingle that are counted.
HELD, MANY = 1 << 21, 1 << 16

_U = np.uint64


@dataclass(frozen=True)
class Measure:
    """Sets of shingles of ``words`` words, linked when 100 * intersection >= ``percent`` * union."""

    words: int = 3
    percent: int = 90

    def set_of(self, text: str) -> np.ndarray:
        return shingle_set(text, self.words)

    def class_bounds(self, most: int) -> list[int]:
        """First sizes of the size classes up to ``most``: linked sets are in the same class or in adjacent ones."""
        bounds = [1]
        while bounds[-1] <= most:
            bounds.append(max(bounds[-1] + 1, (bounds[-1] - 1) * 100 // self.percent + 1))
        return bounds

    def most_different(self, first_of_next: int) -> int:
        """Elements that two linked sets of sizes below ``first_of_next`` can differ in."""
        return 2 * (first_of_next - 1) * (100 - self.percent) // (100 + self.percent)

    def signatures(self, tokens: np.ndarray, bounds: list[int]) -> np.ndarray:
        """Hashes of the parts of a set, for its own size class and for the next one, where it meets larger sets.

        A class in which linked sets cannot differ has no parts, as equal sets are one class already. There are
        some parts to spare, more than a set usually has empty ones: linked sets then agree in a part that
        is not empty. Only a set with more empty parts than that has hashes for those too.
        """
        own = int(np.searchsorted(bounds, len(tokens), side="right")) - 1
        found = []
        spread = mix(tokens * _U(0x9E3779B97F4A7C15) + _U(77))
        values = mix(tokens + _U(5))
        for scheme in (own, own + 1):
            differ = self.most_different(bounds[scheme + 1])
            if not differ:
                continue
            spare = 2 + differ // 12
            parts = differ + 1 + spare
            part = ((spread >> _U(33)) * _U(parts) >> _U(31)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            sums = np.zeros(parts, dtype=np.uint64)
            here, first = np.unique(part[order], return_index=True)
            sums[here] = np.add.reduceat(values[order], first)
            hashed = mix(sums * _U(0xC2B2AE3D27D4EB4F) + np.arange(parts, dtype=np.uint64) * _U(1 << 32) + _U(scheme + 1))
            found.append(hashed[here] if parts - len(here) <= spare else hashed)
        return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)

    def first_places(self, n: Column) -> Column:
        """Length of the prefix in which a linked set must share a shingle."""
        return n - F.ceil(n * self.percent / F.lit(100)) + 1

    def may_link(self, n: Column, pos: Column, other_n: Column, other_pos: Column) -> Column:
        """Size and position bounds of two entries of one list, if the list's shingle is their first common one."""
        needed = F.ceil((n + other_n) * self.percent / F.lit(100 + self.percent))
        return (F.least(n - pos, other_n - other_pos) >= needed) & (F.least(n, other_n) * 100 >= F.greatest(n, other_n) * self.percent)

    def linked(self, one: np.ndarray, other: np.ndarray) -> bool:
        both = len(np.intersect1d(one, other, assume_unique=True))
        return 100 * both >= self.percent * (len(one) + len(other) - both)


#: For near duplicates where nothing else is asked for.
NEAR = Measure(words=5, percent=80)


def _sets(batches: Iterator[pa.RecordBatch], measure: Measure) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [(len(s), *identity(s)) for s in map(measure.set_of, batch.column("text").to_pylist())]
        n, low, high = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(n, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
            names=["doc_id", "mark", "n", "low", "high"],
        )


def _longs(*columns: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names=names)


def packed(key: np.ndarray, low: np.ndarray) -> bytes:
    """Sorted keys and the sets they belong to, compressed: differences of keys, and places in a list of sets."""
    sets, place = np.unique(low, return_inverse=True)
    columns = np.diff(key, prepend=_U(0)), place.astype(np.uint32)
    planes = [c.view(np.uint8).reshape(len(key), -1).T.tobytes() for c in columns]
    head = np.array([len(key), len(sets)], dtype=np.int64).tobytes()
    return zstandard.compress(head + sets.tobytes() + planes[0] + planes[1], 1)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(blob)
    n, n_sets = np.frombuffer(raw, dtype=np.int64, count=2).tolist()
    sets = np.frombuffer(raw, dtype=np.int64, count=n_sets, offset=16)
    start = 16 + 8 * n_sets
    gaps = np.frombuffer(raw, dtype=np.uint8, count=8 * n, offset=start).reshape(8, n).T.copy().view(np.uint64)[:, 0]
    place = np.frombuffer(raw, dtype=np.uint8, count=4 * n, offset=start + 8 * n).reshape(4, n).T.copy().view(np.uint32)[:, 0]
    return np.cumsum(gaps, dtype=np.uint64), sets[place]


def _part_rows(batches: Iterator[pa.RecordBatch], measure: Measure, ranges: int) -> Iterator[pa.RecordBatch]:
    """(range, blob, sure): the parts of each set by ranges of their hashes, and the sets that are sure already.

    Sets that share a part inside the task are sure; of these only the first goes on with that part, so
    what a part brings to its range is one set for each task at most.
    """
    bounds = measure.class_bounds(1 << 20)
    width = _U((1 << 64) // ranges + 1)
    parts: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    seen: set[int] = set()
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        key, low = np.concatenate(parts), np.concatenate(owners)
        order = np.lexsort((low, key))
        key, low = key[order], low[order]
        again = np.concatenate([[False], key[1:] == key[:-1]])
        sure = np.unique(low[again | np.concatenate([again[1:], [False]])])
        key, low = key[~again], low[~again]
        here = (key // width).astype(np.int32)
        starts = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]])).tolist()
        blobs = [packed(key[a:b], low[a:b]) for a, b in zip(starts, [*starts[1:], len(key)])]
        # what is sure travels with the first blob
        lists = [sure.tolist() if i == 0 else [] for i in range(len(starts))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(here[starts], pa.int32()), pa.array(blobs, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
            names=["range", "blob", "sure"],
        )

    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            tokens = measure.set_of(text)
            if not len(tokens):
                continue
            low = identity(tokens)[0]
            if low in seen:
                continue
            seen.add(low)
            if len(tokens) >= bounds[-2]:
                bounds = measure.class_bounds(2 * len(tokens))
            found = measure.signatures(tokens, bounds)
            parts.append(found)
            owners.append(np.full(len(found), low, dtype=np.int64))
            size += len(found)
        if size > HELD:
            yield from flush()
            parts, owners, seen, size = [], [], set(), 0
    if size:
        yield from flush()


def _open_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one or a few ranges: the sets that share a part with another set, or are sure."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for number, blob, sure in zip(*[batch.column(c) for c in ("range", "blob", "sure")]):
            if len(sure):
                yield _longs(np.array(sure.as_py(), dtype=np.int64), names=["low"])
            held.setdefault(number.as_py(), []).append(unpacked(blob.as_py()))
    for pieces in held.values():
        key, low = (np.concatenate(c) for c in zip(*pieces))
        order = np.lexsort((low, key))
        key, low = key[order], low[order]
        meets = (key[1:] == key[:-1]) & (low[1:] != low[:-1])
        found = np.unique(np.concatenate([low[1:][meets], low[:-1][meets]]))
        if len(found):
            yield _longs(found, names=["low"])


def open_classes(texts: DataFrame, measure: Measure) -> DataFrame:
    """(low): names of the sets that may be linked with a different one.

    Parts are dealt out by ranges of their hashes, one for each shuffle partition; hashes are uniform, and
    a part comes once from a task, so ranges are even whatever the groups of similar sets are.
    """
    partitions = shuffle_partitions(texts)
    rows = texts.select("text").mapInArrow(lambda batches: _part_rows(batches, measure, partitions), "range int, blob binary, sure array<long>")
    dealt = rows.repartition(partitions, "range")
    return dealt.mapInArrow(_open_sets, "low long").distinct()


def _with_bits(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows (doc_id, mark, text) whose mark may be among ``marks``: a bitmap of fixed size, no row is lost."""
    place = F.col("mark").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = marks.select(place.alias("place")).select(F.shiftright("place", 6).alias("word"), bit.alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    table = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for row in found:
        table[row["word"]] = row["bits"]
    shared = rows.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("mark").to_numpy() & ((1 << FILTER_BITS) - 1)
            hit = (shared.value[own >> 6] >> (own & 63).astype(np.uint64)) & _U(1)
            kept = batch.filter(pa.array(hit == 1))
            if kept.num_rows:
                yield kept

    return rows.mapInArrow(keep, rows.schema)


def _tokens(batches: Iterator[pa.RecordBatch], measure: Measure) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 128):
        sets = [measure.set_of(t) for t in batch.column("text").to_pylist()]
        ids = np.repeat(batch.column("id").to_numpy(), [len(s) for s in sets])
        yield _longs(np.concatenate(sets), ids, names=["token", "id"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (token, id) sorted by token: those of tokens in several sets, with their number.

    Beyond ``MANY`` the number is not told apart, so a task never holds more rows of one token than that.
    """
    names = ["token", "id", "df"]
    token, ids, last = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), None
    for batch in batches:
        new_token, new_ids = batch.column("token").to_numpy(), batch.column("id").to_numpy()
        if last is not None:  # the run at hand is known to be long, and its rows are not held
            more = int(np.searchsorted(new_token, last, side="right"))
            if more:
                yield _longs(new_token[:more], new_ids[:more], np.full(more, MANY), names=names)
            new_token, new_ids = new_token[more:], new_ids[more:]
            if not len(new_token):
                continue
            last = None
        token, ids = np.concatenate([token, new_token]), np.concatenate([ids, new_ids])
        if not len(token):
            continue
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(token)]]))
        df = np.minimum(np.repeat(sizes, sizes), MANY)
        whole = len(token) if sizes[-1] >= MANY else int(starts[-1])
        told = df[:whole] > 1
        yield _longs(token[:whole][told], ids[:whole][told], df[:whole][told], names=names)
        if whole == len(token):
            last = int(token[-1])
        token, ids = token[whole:], ids[whole:]
    if len(token) > 1:
        yield _longs(token, ids, np.full(len(token), len(token)), names=names)


def index_lists(sets: DataFrame, measure: Measure) -> DataFrame:
    """Entries (token, id, n, pos) of the first shingles, rarest first, of the open sets (id, n, text).

    Shingles of one set alone come first of all; they count as positions but need no list.
    """
    tokens = sets.mapInArrow(lambda batches: _tokens(batches, measure), "token long, id long")
    dealt = tokens.repartition(shuffle_partitions(sets), "token").sortWithinPartitions("token")
    counted = dealt.mapInArrow(_frequencies, "token long, id long, df long")
    common = counted.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("common"))
    room = common.join(sets.select("id", "n"), "id").withColumn("alone", F.col("n") - F.size("common"))
    room = room.withColumn("left", (measure.first_places(F.col("n")) - F.col("alone")).cast("int")).filter("left > 0")
    entries = room.select("id", "n", "alone", F.posexplode(F.slice("common", F.lit(1), F.col("left"))).alias("at", "entry"))
    return entries.select("entry.token", "id", "n", (F.col("alone") + F.col("at")).alias("pos"))


def leader_pairs(entries: DataFrame, measure: Measure) -> DataFrame:
    """(a, b): each entry with the leader of its list."""
    leaders = entries.groupBy("token").agg(F.min(F.struct("pos", "id", "n")).alias("lead"))
    met = entries.join(leaders, "token").filter(F.col("id") != F.col("lead.id"))
    met = met.filter(measure.may_link(F.col("n"), F.col("pos"), F.col("lead.n"), F.col("lead.pos")))
    return met.select(F.least("id", "lead.id").alias("a"), F.greatest("id", "lead.id").alias("b")).distinct()


def _size_class(bounds: list[int]) -> Column:
    """Number of a set's size class."""
    table = F.array(*map(F.lit, bounds))
    return F.size(F.filter(table, lambda b: b <= F.col("n"))) - 1


def list_pairs(entries: DataFrame, measure: Measure) -> DataFrame:
    """(a, b): pairs of entries of one list with different ``label``, by blocks of positions.

    A block is joined only with blocks whose smallest positions add up to no more than linked sets of their
    size classes can differ in.
    """
    bounds = measure.class_bounds(1 << 40)
    differ = F.array(*[F.lit(measure.most_different(b)) for b in [*bounds[1:], 2 * bounds[-1]]])
    placed = (
        entries.withColumn("own", _size_class(bounds))
        .withColumn("scheme", F.explode(F.array("own", F.col("own") + 1)))
        .withColumn("most", F.get(differ, F.col("scheme")))
        .withColumn("width", F.floor(F.col("most") / BLOCKS) + 1)
        .withColumn("block", F.floor(F.col("pos") / F.col("width")).cast("int"))
        .filter(F.col("pos") <= F.col("most"))
    )
    reach = F.floor(F.col("most") / F.col("width")).cast("int") - F.col("block")
    left = placed.filter(reach >= 0).withColumn("wanted", F.explode(F.sequence(F.lit(0), reach)))
    left = left.select(F.col("token"), F.col("scheme"), F.col("wanted").alias("block"), *[F.col(c).alias(f"l_{c}") for c in ("id", "n", "pos", "label")])
    right = placed.select("token", "scheme", "block", *[F.col(c).alias(f"r_{c}") for c in ("id", "n", "pos", "label")])
    met = left.join(right, ["token", "scheme", "block"]).filter((F.col("l_id") < F.col("r_id")) & (F.col("l_label") != F.col("r_label")))
    met = met.filter(measure.may_link(F.col("l_n"), F.col("l_pos"), F.col("r_n"), F.col("r_pos")))
    return met.select(F.col("l_id").alias("a"), F.col("r_id").alias("b")).distinct()


def _linked(batches: Iterator[pa.RecordBatch], measure: Measure) -> Iterator[pa.RecordBatch]:
    last_text, last_set = None, None
    for batch in slices(batches, 256):
        keep = []
        for one, other in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
            if one != last_text:
                last_text, last_set = one, measure.set_of(one)
            keep.append(measure.linked(last_set, measure.set_of(other)))
        found = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([found.column("a"), found.column("b")], names=["a", "b"])


def verified(pairs: DataFrame, sets: DataFrame, measure: Measure) -> DataFrame:
    """The pairs (a, b) that are links, by their whole sets."""
    one = sets.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    other = sets.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one, "a").join(other, "b").mapInArrow(lambda batches: _linked(batches, measure), "a long, b long")


class Classes:
    """Documents, the classes of their sets, and the open classes with their texts."""

    def __init__(self, docs: DataFrame, measure: Measure):
        self.measure = measure
        rows = pick(docs, "doc_id", "text").select("doc_id", whole_text().alias("text")).withColumn("mark", text_mark(F.col("text")))
        self.documents = stored(
            rows.select("doc_id", "mark", "text").mapInArrow(
                lambda batches: _sets(batches, measure), "doc_id long, mark long, n long, low long, high long"), "sets"
        )
        rep = F.min(F.struct("doc_id", "mark")).alias("rep")
        classes = self.documents.filter("n > 0").groupBy("low", "high", "n").agg(F.min("doc_id").alias("least"), rep)
        self.classes = stored(classes, "classes")
        may = open_classes(rows, measure)
        self.open = stored(self.classes.join(may, "low", "left_semi").withColumn("id", F.monotonically_increasing_id()), "open")
        reps = self.open.select("id", "n", F.col("rep.doc_id").alias("rep_id"), F.col("rep.mark").alias("mark"))
        near = _with_bits(rows.select("doc_id", "mark", "text"), reps)
        same = (near["mark"] == reps["mark"]) & near["doc_id"].eqNullSafe(reps["rep_id"])
        texts = near.join(reps, same).select("id", "n", "text").dropDuplicates(["id"])
        self.texts = stored(texts, "open-texts")
        self.entries = stored(index_lists(self.texts, measure), "lists")

    def all_links(self) -> DataFrame:
        """Every link (a, b) between different open classes, by their ids."""
        return verified(list_pairs(self.entries.withColumn("label", F.col("id")), self.measure), self.texts, self.measure)

    def spanning_links(self) -> DataFrame:
        """Links enough to connect all that is linked."""
        first = stored(leader_pairs(self.entries, self.measure), "first-pairs")
        links = stored(verified(first, self.texts, self.measure), "first-links")
        labels = components(links)
        labelled = self.entries.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        mixed = labelled.groupBy("token").agg(F.min("label").alias("one"), F.max("label").alias("other")).filter("one <> other")
        rest = list_pairs(labelled.join(mixed.select("token"), "token", "left_semi"), self.measure).join(first, ["a", "b"], "left_anti")
        return links.unionByName(verified(rest, self.texts, self.measure))


def similar_pairs(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """All links between different sets, (a, b) as the smallest identifiers of the documents that have them.

    Documents with equal sets are found by ``similar_components``.
    """
    found = Classes(docs, measure)
    least = found.open.select("id", "least")
    one, other = least.toDF("a", "least_a"), least.toDF("b", "least_b")
    return found.all_links().join(one, "a").join(other, "b").select(
        F.least("least_a", "least_b").alias("a"), F.greatest("least_a", "least_b").alias("b")
    )


def similar_components(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, mark of the text, n_shingles, component_id.

    ``component_id`` is the smallest doc_id that links reach, its own included. Null and empty texts have no
    shingles and are linked with nothing. Repeated rows get the same component; null identifiers count only
    where a component has no other. An empty table gives no rows; other columns are not looked at.
    """
    found = Classes(docs, measure)
    labels = components(found.spanning_links())
    names = found.open.join(labels, "id").select("low", "high", "n", "label", "least")
    least = names.groupBy("label").agg(F.min("least").alias("component"))
    moved = names.join(least, "label").select("low", "high", "n", "component")
    classes = found.classes.drop("rep").join(moved, ["low", "high", "n"], "left")
    classes = stored(classes.select("low", "high", "n", F.coalesce("component", "least").alias("component")), "components")
    return found.documents.join(classes, ["low", "high", "n"], "left").select(
        "doc_id", "mark", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def drop_similar(docs: DataFrame, measure: Measure = NEAR) -> DataFrame:
    """``docs`` without the rows whose component has a row with a smaller identifier; same columns.

    Texts without words stay, as they are linked with nothing. Of rows without an identifier all stay unless
    their component has one; rows that repeat an identifier and text stay or go together.
    """
    found = similar_components(docs, measure)
    stays = found.filter("component_id <=> doc_id").select("doc_id", "mark").distinct()
    sealed = Sealed(docs)
    mark = text_mark(F.coalesce(sealed["text"], F.lit("")))
    same = sealed["doc_id"].eqNullSafe(stays["doc_id"]) & (mark == stays["mark"])
    return sealed.opened(sealed.frame.join(stays, same, "left_semi"))
