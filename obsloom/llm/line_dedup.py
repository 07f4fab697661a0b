"""Repeated passages by content-defined chunks of lines.

A rolling hash over the hashes of two neighbouring lines is taken at every line, and a chunk ends where it
has a local minimum: boundaries depend on the lines around them alone, so lines put in before do not shift
them, and no two are adjacent. A long line is a chunk of its own. Chunks with equal hashes are compared byte
by byte; of a chunk that stands in several places only the first stays.

Passages that chunks miss are found by windows of whole lines: from every line on, and up to every line, the fewest
lines that reach ``LONG_PASSAGE`` words. In a run of lines of that length that stands earlier too, every line lies in
a window of the run, so the lines of all repeated windows together are the repeated runs. Windows are equal by 128
bits of a cryptographic hash over the lines' own such hashes, which are taken once and kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.llm.quality import MOST_REMOVED, words_of
from obsloom.llm.texts import Sealed, pick, same_row, stored, text_mark, whole_text, without_lines

#: Characters from which on a line is a chunk of its own.
LONG_LINE = 200
#: A repeated chunk goes if it has two lines or more with these words together, or, whatever its lines, those.
FEWEST_LINES, FEWEST_WORDS, LONG_PASSAGE = 2, 10, 50

# Blocks of scripts without spaces between words, as ranges of code points.
UNSPACED_BLOCKS = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3040, 0x30FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF),
]
#: This many of their characters count as one word. A text without a character from the first block on has none of them.
UNSPACED = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in UNSPACED_BLOCKS) + "]"
BEYOND = rf"[\x{{{UNSPACED_BLOCKS[0][0]:X}}}-\x{{10FFFF}}]"
UNSPACED_WORD = 2
#: White space within a line, and runs of it that are not one space.
SPACES = r"\x20\x09\x0B-\x0D"
RAGGED = rf"\x20[{SPACES}]+|[\x09\x0B-\x0D][{SPACES}]*"

DOC = ("doc_id", "mark")


def chunk_ends(lines: Column, rolling: Column) -> Column:
    """Places of the last lines of chunks."""
    is_long = lambda i: F.coalesce(F.length(F.get(lines, i)) >= LONG_LINE, F.lit(False))
    least = lambda i: F.coalesce(
        (F.get(rolling, i) < F.get(rolling, i - 1)) & (F.get(rolling, i) <= F.get(rolling, i + 1)), F.lit(False)
    )
    last = F.size(lines) - 1
    return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | is_long(i) | is_long(i + 1) | least(i))


def chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk: doc_id, mark, its first and last line, and its text."""
    rows = pick(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    lined = rows.select("doc_id", text_mark(F.col("text")).alias("mark"), F.split("text", "\n", -1).alias("lines"))
    hashed = lined.withColumn("hashes", F.transform("lines", lambda line: F.md5(line.cast("binary"))))
    rolled = hashed.withColumn(
        "rolling", F.transform("hashes", lambda h, i: F.md5(F.concat(F.coalesce(F.get("hashes", i - 1), F.lit("")), h)))
    ).drop("hashes")
    ended = rolled.withColumn("ends", chunk_ends(F.col("lines"), F.col("rolling"))).drop("rolling")
    first = lambda k: F.coalesce(F.get("ends", k - 1), F.lit(-1)) + 1
    body = lambda e, k: F.array_join(F.slice("lines", first(k) + 1, e - first(k) + 1), "\n")
    # a chunk's text is taken before its row is made, so that no row carries all lines
    spans = F.transform("ends", lambda e, k: F.struct(first(k).alias("first"), e.alias("last"), body(e, k).alias("chunk")))
    return ended.select(*DOC, F.inline(spans))


def chunk_hash(chunk: Column) -> Column:
    return F.struct(F.xxhash64(chunk).alias("low"), F.xxhash64(chunk, F.lit(1)).alias("high"))


def place() -> Column:
    """Order of places: identifier (nulls last), text, line."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark", "first")


def repeated_chunks(found: DataFrame) -> DataFrame:
    """(hash, stays): chunks that stand in several places, and their first place.

    The texts of a hash are gathered as a set, which compares bytes; a hash of several texts is left alone.
    Equal chunks are joined inside each task before they are shuffled.
    """
    grouped = found.groupBy(chunk_hash(F.col("chunk")).alias("hash")).agg(
        F.collect_set("chunk").alias("texts"), F.count(F.lit(1)).alias("n"), F.min(place()).alias("stays"),
        F.max(F.col("last") - F.col("first") + 1).alias("n_lines"),
    )
    words = F.size(words_of(F.get("texts", F.lit(0))))
    big = (words >= LONG_PASSAGE) | ((F.col("n_lines") >= FEWEST_LINES) & (words >= FEWEST_WORDS))
    return grouped.filter((F.col("n") > 1) & (F.size("texts") == 1)).filter(big).select("hash", "stays")


def n_words(line: Column) -> Column:
    """Number of words of a line in which every run of white space is one space."""
    trimmed = F.btrim(line, F.lit(" "))
    return F.when(trimmed == "", 0).otherwise(F.length(trimmed) - F.length(F.translate(trimmed, " ", "")) + 1)


def line_weights(text: Column) -> Column:
    """Lengths of the lines: ``UNSPACED_WORD`` for each word, and one for each character of a script without spaces.

    Patterns go over the whole text, once each, and those of scripts only where it may have such characters; what is
    asked inside a function of lines is asked again for every line.
    """
    split = lambda whole: F.split(whole, "\n", -1)
    tidy, words = F.regexp_replace(text, RAGGED, " "), F.regexp_replace(text, f"[{SPACES}{UNSPACED[1:]}+", " ")
    rest = F.regexp_replace(tidy, f"{UNSPACED}+", "")
    each = F.arrays_zip(split(tidy), split(words), split(rest))
    counted = F.transform(each, lambda x: UNSPACED_WORD * n_words(x["1"]) + F.length(x["0"]) - F.length(x["2"]))
    # a text with as many bytes as characters has none beyond ASCII, which is cheaper to ask than a pattern
    may_have = (F.octet_length(text) > F.length(text)) & text.rlike(BEYOND)
    return F.when(may_have, counted).otherwise(F.transform(split(tidy), lambda line: UNSPACED_WORD * n_words(line)))


#: Lines among which a window's end is looked for first; most windows are shorter.
NEAR_LINES = 8


def weighed_lines(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, mark, ``spoken`` (place and weight of the lines with a word), and the lines' hashes."""
    rows = pick(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    weighed = F.transform(line_weights(F.col("text")), lambda weight, i: F.struct(i.alias("place"), weight.alias("weight")))
    return rows.select(
        "doc_id", text_mark(F.col("text")).alias("mark"), F.filter(weighed, lambda x: x["weight"] > 0).alias("spoken"),
        F.transform(F.split("text", "\n", -1), lambda line: F.md5(line.cast("binary"))).alias("hashes"),
    )


def windows(weighed: DataFrame) -> DataFrame:
    """One row per window of ``weighed_lines``: doc_id, mark, its first and last line, and its hash.

    Lines without a word begin and end no window, so a window has no more than ``LONG_PASSAGE`` times
    ``UNSPACED_WORD`` lines with words.
    """
    limit = LONG_PASSAGE * UNSPACED_WORD
    spoken = F.col("spoken")

    def reach(part: Column) -> Column:
        """How many of the leading weights reach the limit; null if all of them do not."""
        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
        step = lambda a, x: F.when(a["sum"] >= limit, a).otherwise(
            F.struct((a["sum"] + x["weight"]).alias("sum"), (a["n"] + 1).alias("n"))
        )
        return F.aggregate(part, start, step, lambda a: F.when(a["sum"] >= limit, a["n"]))

    def nearest(part: Callable[[int], Column]) -> Column:
        return F.coalesce(reach(part(NEAR_LINES)), reach(part(limit)))

    # start and length, as start and end would nearly cancel out in the hash by which the union tells numbers apart
    packed = lambda first, last: F.shiftleft(first.cast("long"), 32).bitwiseOR((last - first).cast("long"))
    after = lambda x, k: packed(
        x["place"], F.get(spoken, k + nearest(lambda n: F.slice(spoken, k + 1, F.lit(n))) - 1)["place"]
    )
    start = lambda k, n: F.greatest(k + 1 - n, F.lit(0))
    behind = lambda k, n: F.reverse(F.slice(spoken, start(k, n) + 1, k - start(k, n) + 1))
    before = lambda x, k: packed(
        F.get(spoken, k - nearest(lambda n: behind(k, n)) + 1)["place"], x["place"]
    )
    both = F.array_compact(F.array_union(F.transform(spoken, after), F.transform(spoken, before)))
    first = lambda w: F.shiftright(w, 32).cast("int")
    last = lambda w: (F.shiftright(w, 32) + w.bitwiseAND(F.lit((1 << 32) - 1))).cast("int")
    # the hashes are kept as text, which a window joins as it is; a line stands in many windows
    body = lambda w: F.array_join(F.slice("hashes", first(w) + 1, last(w) - first(w) + 1), "")
    each = F.transform(both, lambda w: F.struct(first(w).alias("first"), last(w).alias("last"), F.unhex(F.md5(body(w).cast("binary"))).alias("hash")))
    return weighed.select(*DOC, F.inline(each))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Windows that stand earlier too, as (doc_id, mark, first, last); one that its first place overlaps is none."""
    found = windows(stored(weighed_lines(docs), "weighed-lines"))
    first = F.min(F.struct(place().alias("at"), "last"))
    again = found.groupBy("hash").agg(first.alias("stays"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    both = found.join(stored(again, "repeated-windows"), "hash")
    stays = F.col("stays.at")
    same_doc = F.struct("doc_id", "mark").eqNullSafe(F.struct(stays["doc_id"].alias("doc_id"), stays["mark"].alias("mark")))
    return both.filter(~same_doc | (F.col("first") > F.col("stays.last"))).select(*DOC, "first", "last")


def gone_chunks(docs: DataFrame) -> DataFrame:
    """Chunks that stand earlier too, as (doc_id, mark, first, last)."""
    found = chunks(docs)
    repeated = stored(repeated_chunks(found), "repeated-chunks")
    places = found.select(*DOC, "first", "last", chunk_hash(F.col("chunk")).alias("hash"))
    return places.join(repeated, "hash").filter(~place().eqNullSafe(F.col("stays"))).select(*DOC, "first", "last")


def removed_passages(docs: DataFrame) -> DataFrame:
    """Per document that loses lines: doc_id, mark, and the sorted places of the lines of its repeated chunks and runs."""
    gone = gone_chunks(docs).unionByName(repeated_windows(docs))
    lines = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"])))
    spans = gone.groupBy(*DOC).agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    return spans.select(*DOC, F.sort_array(F.array_distinct(lines)).alias("places"))


def line_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_lines, n_removed_lines, clean_text.

    A null text is an empty one; empty texts and blank lines are never passages. Rows that repeat an
    identifier and text are one document: both keep or lose the same lines, and they count as copies of
    other documents, not of each other. An empty table gives no rows; other columns are not looked at.
    """
    rows = pick(docs, "doc_id", "text").select("doc_id", whole_text().alias("text")).withColumn("mark", text_mark(F.col("text")))
    removed = removed_passages(docs)
    return rows.join(removed, same_row(rows, removed, *DOC), "left").select(
        rows["doc_id"],
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed_lines"),
        without_lines(F.col("text"), F.col("places")).alias("clean_text"),
    )


def dedup_lines(docs: DataFrame, drop_depleted: bool = False) -> DataFrame:
    """``docs`` with the repeated chunks and passages taken out of the texts; the same columns.

    All rows stay, with ``drop_depleted`` all but those that lose more than half of their words, copies and near copies of
    earlier documents among them. Null and empty texts lose nothing and stay. Rows that repeat an identifier and text
    keep or lose the same lines. An empty table gives no rows; extra columns are passed on.
    """
    sealed, removed = Sealed(docs), removed_passages(docs)
    mark = text_mark(F.coalesce(sealed["text"], F.lit("")))
    same = sealed["doc_id"].eqNullSafe(removed["doc_id"]) & (mark == removed["mark"])
    joined = sealed.frame.join(removed, same, "left").withColumn("clean", without_lines(sealed["text"], F.col("places")))
    if drop_depleted:
        left, whole = (F.size(words_of(text)) for text in (F.col("clean"), sealed["text"]))
        joined = joined.filter(F.col("places").isNull() | (whole - left <= MOST_REMOVED * whole))
    return sealed.opened(joined, F.col("clean"))
