"""Quality rules: counts per document, and line frequency across the documents of a host.

A line that stands in more different texts of one host than the limit is boilerplate there; a document that
loses most of its words with such lines is depleted. Lines are compared after trimming, joining white space
and lower-casing; copies of one text count once, so a copied document is not taken for boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.llm.texts import SPACE, Sealed, pick, same_row, stored, text_mark, whole_text, without_lines

#: Different texts of a host in which a line may stand, whatever the size of the host.
MIN_TEXTS = 10
#: A document is depleted when more than this share of its words goes.
MOST_REMOVED = 0.5
FEWEST_WORDS = 50
MOST_REPEATED = 0.5

SYMBOLS = "#*$%&|<>"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Bits that hold a word's place beside its window's hash; longer documents take the path without hashes.
PLACE_BITS = 22

DOC = ("doc_id", "mark", "host")


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def _window(words: Column, i: Column) -> list[Column]:
    return [F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)]


def _covered(places: Column) -> Column:
    """Number of words in the windows that begin at ``places``."""
    return F.size(F.array_union(F.array_union(places, F.transform(places, lambda p: p + 1)), F.transform(places, lambda p: p + 2)))


def _by_text(words: Column) -> Column:
    """Places of repeated windows by sorting the windows themselves."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.concat_ws(" ", *_window(words, i)).alias("w"), i.alias("i")),
    )
    same = lambda s, j, k: F.coalesce(F.get(s, j)["w"] == F.get(s, k)["w"], F.lit(False))
    repeated = lambda s: F.filter(
        F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(s, j, j - 1) | same(s, j, j + 1)
    )
    found = F.transform(F.array(F.sort_array(windows)), lambda s: F.transform(repeated(s), lambda j: F.get(s, j)["i"]))
    return F.get(found, F.lit(0))


def with_repeats(df: DataFrame) -> DataFrame:
    """``df`` with array ``words`` gets ``n_repeat_words``: words in 3-word windows found twice or more.

    Hashes of the windows are sorted with their places; equal neighbours are compared word by word. A
    document with unequal windows of one hash, or with more words than a place can hold, is sorted by the
    windows themselves.
    """
    mask = (1 << PLACE_BITS) - 1
    words, packed, pairs = F.col("words"), F.col("packed"), F.col("pairs")
    long = F.size(words) > mask
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.shiftleft(F.xxhash64(*_window(words, i)), PLACE_BITS).bitwiseOR(i.cast("long")),
    )
    place = lambda j: F.get(packed, j).bitwiseAND(F.lit(mask)).cast("int")
    mark = lambda j: F.shiftrightunsigned(F.get(packed, j), PLACE_BITS)
    none = F.array().cast("array<int>")
    found = (
        df.withColumn("packed", F.when((F.size(words) > 3) & ~long, F.sort_array(hashed)).otherwise(F.array().cast("array<bigint>")))
        .withColumn(
            "pairs",
            F.when(F.size(packed) > 1, F.filter(F.sequence(F.lit(1), F.size(packed) - 1), lambda j: mark(j) == mark(j - 1))).otherwise(none),
        )
        .withColumn(
            "unequal",
            F.exists(pairs, lambda j: F.struct(*_window(words, place(j))) != F.struct(*_window(words, place(j - 1)))),
        )
    )
    by_hash = F.array_union(F.transform(pairs, place), F.transform(pairs, lambda j: place(j - 1)))
    covered = F.when(long | F.col("unequal"), _covered(_by_text(words))).when(F.size(pairs) > 0, _covered(by_hash)).otherwise(0)
    return found.withColumn("n_repeat_words", covered.cast("long")).drop("packed", "pairs", "unequal")


def base_counts(docs: DataFrame, host: str) -> DataFrame:
    """Per row: its key (doc_id, mark, host), and the counts."""
    rows = pick(docs, "doc_id", "text", host).toDF("doc_id", "text", "host").withColumn("text", whole_text())
    symbols = F.length("text") - F.length(F.translate("text", SYMBOLS, ""))
    lines = F.split("text", "\n", -1)
    spoken = F.filter(lines, lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")
    return with_repeats(
        rows.select(
            "doc_id", text_mark(F.col("text")).alias("mark"), "host",
            words_of(F.col("text")).alias("words"),
            F.length(F.translate("text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            (F.size(spoken) - F.size(F.array_distinct(spoken))).cast("long").alias("n_dup_lines"),
        )
    ).withColumn("n_words", F.size("words").cast("long")).drop("words")


def kept_counts(docs: DataFrame, host: str) -> DataFrame:
    """``base_counts`` written to a table.

    A filter on a count would otherwise be moved below it, with the whole computation repeated for every
    element of its arrays.
    """
    return stored(base_counts(docs, host), "counts")


def line_rows(docs: DataFrame, host: str) -> DataFrame:
    """One row per line with a word: the document's key, the line's place, hash and number of words."""
    rows = pick(docs, "doc_id", "text", host).toDF("doc_id", "text", "host").withColumn("text", whole_text())
    tidy = F.split(F.lower(F.regexp_replace("text", r"[\x20\x09\x0B-\x0D]+", " ")), "\n", -1)
    each = rows.select("doc_id", text_mark(F.col("text")).alias("mark"), "host", F.posexplode(tidy).alias("place", "raw"))
    line = F.btrim("raw", F.lit(" "))
    return each.select(*DOC, "place", line.alias("tidy")).filter("tidy != ''").select(
        *DOC, "place", F.xxhash64("tidy").alias("line"),
        (F.length("tidy") - F.length(F.translate("tidy", " ", "")) + 1).alias("words"),
    )


def frequent_lines(lines: DataFrame, min_texts: int = MIN_TEXTS) -> DataFrame:
    """(host, line hash) of the ``line_rows`` that stand in more than ``min_texts`` different texts of their host."""
    texts = lines.groupBy("host", "line", "mark").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("texts"))
    return texts.filter(F.col("texts") > min_texts).select("host", "line")


def removed_lines(docs: DataFrame, host: str, min_texts: int = MIN_TEXTS) -> DataFrame:
    """Per document with boilerplate: its key, the sorted places of the lines that go, and how many words they have."""
    lines = stored(line_rows(docs, host), "lines")
    frequent = stored(frequent_lines(lines, min_texts), "frequent-lines")
    hits = lines.join(frequent, same_row(lines, frequent, "host", "line"), "left_semi").distinct()
    return hits.groupBy(*DOC).agg(F.sort_array(F.collect_list("place")).alias("places"), F.sum("words").alias("removed_words"))


def _failed() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def quality_report(docs: DataFrame, host: str = "source", min_texts: int = MIN_TEXTS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and the host column): the counts and the verdict.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    removed_words, n_removed_lines, kept. A null text has no words and fails; a null host is a host of its
    own; rows that repeat an identifier, text and host get the same verdict. An empty table gives no rows;
    other columns are not looked at.
    """
    counts, removed = kept_counts(docs, host), removed_lines(docs, host, min_texts)
    judged = counts.join(removed, same_row(counts, removed, *DOC), "left").select(
        counts["doc_id"], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce("removed_words", F.lit(0).cast("long")).alias("removed_words"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed_lines"),
    )
    failed = _failed()
    depleted = F.col("removed_words") > MOST_REMOVED * F.col("n_words")
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def apply_quality(docs: DataFrame, host: str = "source", min_texts: int = MIN_TEXTS) -> DataFrame:
    """``docs`` without the rows that the report rejects, and without boilerplate lines in the others.

    Columns stay as they are, ``n_chars`` (if there is one) follows the new text. Null and empty texts have no words
    and go. Repeated rows all stay or all go; a null host is a host of its own. An empty table stays empty.
    """
    sealed, report = Sealed(docs), kept_counts(docs, host)
    removed = removed_lines(docs, host, min_texts)
    verdict = report.select(*DOC, "n_words", _failed().alias("failed")).distinct()
    judged = verdict.join(removed, same_row(verdict, removed, *DOC), "left").filter(
        ~F.col("failed") & (F.coalesce("removed_words", F.lit(0)) <= MOST_REMOVED * F.col("n_words"))
    ).select(*[verdict[c] for c in DOC], "places")
    mark = text_mark(F.coalesce(sealed["text"], F.lit("")))
    same = sealed["doc_id"].eqNullSafe(judged["doc_id"]) & (mark == judged["mark"]) & sealed[host].eqNullSafe(judged["host"])
    return sealed.opened(sealed.frame.join(judged, same), without_lines(sealed["text"], F.col("places")))
