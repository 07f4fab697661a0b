"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.session import work_path

#: White space of all contracts: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no others, found by their exact spelling and first place.

    Columns that differ in case only, or that repeat a name, make a name ambiguous for Spark; by place
    they do not. A missing name is an error.
    """
    places = [df.columns.index(name) for name in names]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[plain[f"c{i}"].alias(name) for i, name in zip(places, names)])


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_mark(text: Column) -> Column:
    """With the identifier, what tells two rows apart: rows that share both are one and the same row."""
    return F.xxhash64(text)


def same_row(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Join condition on ``names`` where nulls equal nulls."""
    condition = left[names[0]].eqNullSafe(right[names[0]])
    for name in names[1:]:
        condition &= left[name].eqNullSafe(right[name])
    return condition


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a table in the shared work folder, where lost executors do not matter, and read again.

    A join with it starts from files on that side, so that adaptive execution may split its hot keys.
    """
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    """The number of partitions that the session gives to a shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def without_lines(text: Column, places: Column) -> Column:
    """``text`` without the lines at ``places``, a sorted array of different places; unchanged where that is null.

    What lies between two places is taken as one slice, so the work grows with the lines and not with lines times places.
    """

    def rest(split: Column) -> Column:
        lines = split["lines"]
        gaps = F.transform(
            F.sequence(F.lit(0), F.size(places)),
            lambda k: F.struct(
                (F.coalesce(F.get(places, k - 1), F.lit(-1)) + 1).alias("start"), F.coalesce(F.get(places, k), F.size(lines)).alias("stop")
            ),
        )
        kept = F.filter(gaps, lambda gap: gap["start"] < gap["stop"])
        return F.array_join(F.transform(kept, lambda gap: F.array_join(F.slice(lines, gap["start"] + 1, gap["stop"] - gap["start"]), "\n")), "\n")

    # as the variable of a function the lines are split once, and not again for every gap
    once = F.transform(F.array(F.struct(F.split(text, "\n", -1).alias("lines"))), rest)
    return F.when(places.isNull(), text).otherwise(F.get(once, F.lit(0)))


class Sealed:
    """A table whose columns go by place while operators work, so that no name can clash.

    ``frame`` has the columns under private names and ``name`` gives the private name of one; ``opened``
    takes the columns back out of a frame derived from it, under their own names and in their order.
    """

    def __init__(self, docs: DataFrame):
        self.columns = docs.columns
        self.frame = docs.toDF(*[f"sealed {i}" for i in range(len(docs.columns))])

    def name(self, column: str) -> str:
        return f"sealed {self.columns.index(column)}"

    def __getitem__(self, column: str) -> Column:
        return F.col(f"`{self.name(column)}`")

    def opened(self, frame: DataFrame, text: Column | None = None) -> DataFrame:
        """With ``text`` in place of the column text; ``n_chars``, if there is one, then follows it."""
        values = [F.col(f"`sealed {i}`") for i in range(len(self.columns))]
        if text is not None:
            values[self.columns.index("text")] = text
            if "n_chars" in self.columns:
                values[self.columns.index("n_chars")] = F.length(text).cast("long")
        return frame.select(*values).toDF(*self.columns)
