"""The previous reading of an entity across micro-batches, kept in Spark's own state store.

State is one value per entity: its last reading. What a micro-batch brings of an entity is put in order and each
reading takes its values from the one before, the first from the state. Spark versions the state with its
checkpoint, so a repeated micro-batch starts from the same state and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from obsloom.streaming.ingest import append_stream

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATE = "late"


class LastReading(StatefulProcessor):
    """Rows of an entity with its reading before, and whether they came too late.

    Every column that is needed travels once, as ``r0, r1, ..``: each value of each row is turned into a Python object
    and back. ``order`` and ``values`` name those that make a row's place and those to look back to; the first
    ``columns`` are passed on. A key that is left out of the row is found in ``key``.
    """

    def __init__(self, state: T.StructType, columns: int, order: Sequence[str], values: Sequence[str], key: str | None):
        self.state, self.columns, self.order, self.values, self.key = state, columns, order, values, key
        self.found = Row(*[f"r{i}" for i in range(columns)], *[f"f{i}" for i in range(len(values))], LATE)
        self.places = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.state)

    def placed(self, key: tuple, rows: Iterator[Row]) -> Iterator[tuple[tuple, tuple, tuple, tuple]]:
        """(place, order, values, passed on) of each row; the names of a row's columns are looked up once."""
        for row in rows:
            if self.places is None:
                at = {name: i for i, name in enumerate(row.__fields__)}
                passed = [f"r{i}" for i in range(self.columns)]
                self.places = [[None if name == self.key else at[name] for name in names] for names in (self.order, self.values, passed)]
            order, values, passed = (tuple([key[0] if i is None else row[i] for i in places]) for places in self.places)
            yield in_order(order), order, values, passed

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        known = self.last.get() if self.last.exists() else None
        before, bound = known, None if known is None else in_order(known[: len(self.order)])
        for place, order, values, passed in sorted(self.placed(key, rows), key=lambda row: row[0]):
            late = bound is not None and place <= bound
            looked = (None,) * len(self.values) if late or before is None else before[len(self.order) :]
            yield self.found(*passed, *looked, late)
            if not late:
                before = order + values
        if before is not None and before is not known:
            self.last.update(before)

    def close(self) -> None:
        pass


def in_order(place: Sequence) -> tuple:
    """Sorts like Spark's ascending order, NULL first."""
    return tuple((value is not None, value) for value in place)


def with_state(spark: SparkSession) -> None:
    """Keyed state needs the store that Spark ships for it; a session that names another one says so itself."""
    if spark.conf.get(STORE, None) != ROCKS:
        spark.conf.set(STORE, ROCKS)


def lagged_stream(stream: DataFrame, values: Mapping[str, str], key: str, order: Sequence[str]) -> DataFrame:
    """``stream`` with for each ``out: column`` the value of the entity's reading before, and ``late``.

    ``order`` must be a total order within an entity. A row that is not after its entity's last reading of earlier
    micro-batches is late: it is passed on, but it is no one's previous reading and has none itself. A NULL key is an
    entity of its own. The readings that one micro-batch has of one entity meet in one task, so the source's limit
    per micro-batch (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) bounds them.
    """
    with_state(stream.sparkSession)
    columns = stream.columns
    instants = {f.name for f in stream.schema.fields if isinstance(f.dataType, T.TimestampType)}
    # instants are kept as numbers, which no time zone of a Python process can move
    plain = lambda c: F.unix_micros(F.col(c)) if c in instants else F.col(c)
    needed = list(dict.fromkeys([*columns, *order, *values.values()]))
    name = {c: f"r{i}" for i, c in enumerate(needed)}
    # a key that groups equal values only, and not what is merely taken for equal, need not travel in the row as well
    same = key in columns and (stream.schema[key].dataType == T.StringType() or isinstance(stream.schema[key].dataType, T.IntegralType))
    every = stream.select(plain(key).alias("k"), *[plain(c).alias(r) for c, r in name.items()])
    packed = every.drop(name[key]) if same else every
    kinds = {c: every.schema[r].dataType for c, r in name.items()}
    state = T.StructType(
        [
            *[T.StructField(f"o{i}", kinds[c]) for i, c in enumerate(order)],
            *[T.StructField(f"v{i}", kinds[c]) for i, c in enumerate(values.values())],
        ]
    )
    shape = T.StructType(
        [
            *[T.StructField(name[c], kinds[c]) for c in columns],
            *[T.StructField(f"f{i}", kinds[c]) for i, c in enumerate(values.values())],
            T.StructField(LATE, T.BooleanType()),
        ]
    )
    reading = LastReading(state, len(columns), [name[c] for c in order], [name[c] for c in values.values()], name[key] if same else None)
    found = packed.groupBy("k").transformWithState(reading, shape, "Append", "None")
    timed = lambda c, given: (F.timestamp_micros(F.col(given)) if c in instants else F.col(given))
    lags = [timed(c, f"f{i}").alias(out) for i, (out, c) in enumerate(values.items())]
    return found.select(*[timed(c, name[c]).alias(c) for c in columns if c not in values], *lags, LATE)


def lag_stream(
    stream: DataFrame, values: Mapping[str, str], key: str, order: Sequence[str], out: str, checkpoint: str
) -> StreamingQuery:
    """:func:`lagged_stream` appended to the Parquet folder ``out``, exactly once per reading."""
    return append_stream(lagged_stream(stream, values, key, order), out, checkpoint)
