"""Token ids in files: every document is its own zstandard frame under a shared dictionary.

A file set has a dictionary (trained on the serialised ids of a sample) and shards in ascending order of
doc_id. A shard is one binary value of a Parquet table, so that any store Spark writes to will do and a
lost task leaves nothing behind. Its bytes:

    magic   4 bytes  TIDZ
    width   u1       bytes of an id, 2 or 4, little-endian
    count   u4       documents
    hash    32 bytes SHA-256 of the dictionary
    index   count entries of INDEX: identifier, place of the frame after the index, ids in it
    frames  zstandard, one for each document

A reader checks the hash, finds a document in the index, and decompresses its frame alone.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsloom.llm.byte_bpe import CHUNK, TAIL, of_process, pieces, slices, split_tail
from obsloom.llm.texts import pick, shuffle_partitions, text_mark, whole_text

MAGIC, HASH_BYTES = b"TIDZ", 32
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("at", "<u8"), ("tokens", "<u4")])
#: A shard is closed at this size; small enough that Parquet never has many of them in memory.
SHARD_BYTES = 1 << 18
#: The dictionary: its size, and the documents and the characters of each that it is trained on. It only
#: decides how well frames compress; every document is encoded whole.
DICTIONARY_BYTES, SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 1 << 16, 2000, 1 << 14
LEVEL = 3
END = 2
#: Words whose ids a process remembers.
REMEMBERED = 900_000

SHARD_SCHEMA = "part int, seq int, first_id long, last_id long, n_docs long, n_tokens long, blob binary"


class WordEncoder:
    """Ids of texts under a tokenizer that drops white space and lower-cases, so that words are encoded one by one.

    New words go to the library together. Words of letters alone end with an id that marks a word's end;
    between others stands a separator. The ids of words are remembered.
    """

    SEPARATOR, WORD_END = "\x01", "</w>"

    def __init__(self, json: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        self.library, self.width, self.kind = Tokenizer.from_str(json), width, f"<u{width}"
        (self.separator,) = self.library.encode(self.SEPARATOR, add_special_tokens=False).ids
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(self.WORD_END)]] = True
        self.known: dict[str, bytes] = {"": b""}

    def _together(self, words: list[str], letters: bool) -> None:
        if not words:
            return
        joined = " ".join(words) if letters else f" {self.SEPARATOR} ".join(words)
        ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=np.int64)
        if letters:
            ends = np.flatnonzero(self.ends[ids]) + 1
            starts = np.concatenate([[0], ends[:-1]])
        else:
            cuts = np.flatnonzero(ids == self.separator)
            starts, ends = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(ids)]])
        if len(ends) != len(words):  # a character that this process takes for a letter and the library does not
            self.known.update((word, self.plain(word)) for word in words)
            return
        raw = ids.astype(self.kind).tobytes()
        for word, a, b in zip(words, (self.width * starts).tolist(), (self.width * ends).tolist()):
            self.known[word] = raw[a:b]

    def learn(self, words: Iterable[str]) -> None:
        known, split, wanted = self.known, [], set()
        for word in words:
            core, tail = split_tail(word) if word[-1:] in TAIL else (word, "")
            if core.isascii() and core.isalpha() and not core.islower():
                core = core.lower()
            if core is word:
                wanted.add(word)
                continue
            split.append((word, core, tail))
            if core not in known:
                wanted.add(core)
            if tail not in known:
                wanted.add(tail)
        batches: dict[bool, list[str]] = {True: [], False: []}
        size = dict.fromkeys(batches, 0)
        for word in wanted:
            if self.SEPARATOR in word or len(word) > CHUNK // 8:
                known[word] = self.plain(word)
                continue
            letters = word.isalpha() and (word.isascii() or word.lower().isalpha() and is_normalized("NFC", word))
            batches[letters].append(word)
            size[letters] += len(word) + 3
            if size[letters] > CHUNK // 8:
                self._together(batches[letters], letters)
                batches[letters], size[letters] = [], 0
        for letters, batch in batches.items():
            self._together(batch, letters)
        for word, core, tail in split:
            known[word] = known[core] + known[tail]

    def plain(self, text: str) -> bytes:
        """Ids of a whole text from the library, a bounded number of characters at a time."""
        parts = [self.library.encode_batch_fast([p], add_special_tokens=False)[0].ids for p in pieces(text)]
        return b"".join(np.array(p, dtype=self.kind).tobytes() for p in parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Serialised ids of each text. Only plain spaces and line ends separate words here."""
        split = [text.replace("\n", " ").split(" ") for text in texts]
        met = set().union(*split)
        new = met.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {"": b""}
            new = met - {""}
        self.learn(new)
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def word_encoder(json: str, width: int) -> WordEncoder:
    def new_word_encoder() -> WordEncoder:
        return WordEncoder(json, width)

    return of_process(f"{width} {json}", new_word_encoder)


def pack_shard(rows: list[tuple[int | None, int, bytes]], width: int, dictionary_hash: bytes) -> bytes:
    """Bytes of a shard from (identifier, ids, frame) in order."""
    index = np.zeros(len(rows), dtype=INDEX)
    at = 0
    for i, (doc_id, tokens, frame) in enumerate(rows):
        index[i] = (doc_id or 0, doc_id is not None, at, tokens)
        at += len(frame)
    head = MAGIC + bytes([width]) + len(rows).to_bytes(4, "little") + dictionary_hash
    return b"".join([head, index.tobytes(), *[frame for _, _, frame in rows]])


class Shard:
    """Reader of a shard's bytes."""

    def __init__(self, blob: bytes, dictionary: bytes):
        head = len(MAGIC) + 5
        count = int.from_bytes(blob[5:head], "little")
        if blob[:4] != MAGIC or blob[head : head + HASH_BYTES] != hashlib.sha256(dictionary).digest():
            raise ValueError("not a shard of this dictionary")
        self.width, start = blob[4], head + HASH_BYTES
        self.index = np.frombuffer(blob, dtype=INDEX, count=count, offset=start)
        self.blob, self.frames = blob, start + count * INDEX.itemsize
        self.reader = zstandard.ZstdDecompressor(dict_data=as_dictionary(dictionary))

    def ids(self, i: int) -> np.ndarray:
        """Ids of the document at place ``i``: one frame is read."""
        start = self.frames + int(self.index["at"][i])
        end = self.frames + int(self.index["at"][i + 1]) if i + 1 < len(self.index) else len(self.blob)
        size = self.width * int(self.index["tokens"][i])
        raw = self.reader.decompress(self.blob[start:end], max_output_size=max(1, size))
        return np.frombuffer(raw, dtype=f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int) -> list[int]:
        """Places of a document; the index is in order of identifiers, those without one first."""
        nameless = int(np.searchsorted(self.index["known"], 1))
        ids = self.index["doc_id"][nameless:]
        first, last = np.searchsorted(ids, doc_id, side="left"), np.searchsorted(ids, doc_id, side="right")
        return list(range(nameless + int(first), nameless + int(last)))


def as_dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def train_dictionary(docs: DataFrame, json: str, width: int) -> bytes:
    """A dictionary from the ids of about ``SAMPLE_DOCUMENTS`` documents, chosen by hash; empty if they are too few."""
    rows = pick(docs, "doc_id", "text")
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, rows.count()))
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    texts = chosen.limit(2 * SAMPLE_DOCUMENTS).select(F.substring(whole_text(), 1, SAMPLE_CHARACTERS).alias("text"))
    sample = [r["text"] for r in texts.collect()]
    encoder = WordEncoder(json, width)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, encoder.encode(sample), level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end: int = END) -> None:
    """Encode every whole text of ``docs`` (doc_id, text), append ``end``, and write the file set below ``path``.

    Documents lie in ascending order of doc_id, null identifiers first, repeated identifiers by their text.
    Null and empty texts have the end id alone. An empty table gives a file set without shards. Other
    columns are not looked at. The tokenizer must drop white space between words.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        json = file.read()
    width = 2 if Tokenizer.from_str(json).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
    dictionary = train_dictionary(docs, json, width)
    spark.createDataFrame([(dictionary,)], "dictionary binary").write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((json, dictionary))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of_library, raw = shared.value
        encoder, mark = word_encoder(text_of_library, width), hashlib.sha256(raw).digest()
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=as_dictionary(raw))
        last = int(end).to_bytes(width, "little")
        part, seq, rows, size = TaskContext.get().partitionId(), 0, [], 0

        def shard() -> pa.RecordBatch:
            ids = [r[0] for r in rows]
            values = [part, seq, ids[0], ids[-1], len(rows), sum(r[1] for r in rows), pack_shard(rows, width, mark)]
            types = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
            names = ["part", "seq", "first_id", "last_id", "n_docs", "n_tokens", "blob"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

        for batch in slices(batches, 1024):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                ids += last
                rows.append((doc_id, len(ids) // width, writer.compress(ids)))
                size += len(rows[-1][2]) + INDEX.itemsize
                if size >= SHARD_BYTES:
                    yield shard()
                    seq, rows, size = seq + 1, [], 0
        if rows:
            yield shard()

    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    ordered = rows.repartitionByRange(shuffle_partitions(docs), "doc_id").sortWithinPartitions("doc_id", text_mark(whole_text()))
    shards = ordered.mapInArrow(write, SHARD_SCHEMA)
    shards.write.option("compression", "none").option("parquet.block.size", 1 << 24).parquet(f"{path}/shards")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()[0])


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, base): the number of ids before each shard, by totals of the parts and then inside each."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), zero).alias("part_base"))
    own = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), zero).alias("own_base"))
    return own.join(parts, "part").select("part", "seq", (F.col("part_base") + F.col("own_base")).alias("base"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the file set: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The ids are read back from the files; the checksum is that of the ids as little-endian unsigned 32-bit
    integers.
    """
    dictionary = spark.sparkContext.broadcast(read_dictionary(spark, path))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, blob in zip(*[batch.column(c) for c in ("part", "seq", "blob")]):
                shard = Shard(blob.as_py(), dictionary.value)
                n, tokens = len(shard.index), shard.index["tokens"].astype(np.int64)
                known = shard.index["known"] == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part.as_py(), dtype=np.int32)), pa.array(np.full(n, seq.as_py(), dtype=np.int32)),
                        pa.array(shard.index["doc_id"], mask=known), pa.array(np.cumsum(tokens) - tokens), pa.array(tokens),
                        pa.array([zlib.crc32(shard.ids(i).tobytes()) for i in range(n)], pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "own_start", "n_tokens", "ids_crc32"],
                )

    shards = spark.read.parquet(f"{path}/shards")
    starts = shard_starts(shards.select("part", "seq", "n_tokens"))
    schema = "part int, seq int, doc_id long, own_start long, n_tokens long, ids_crc32 long"
    read_back = shards.select("part", "seq", "blob").mapInArrow(read, schema)
    return read_back.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """Ids of a few documents: only shards whose range holds one are read, and only their frames decompressed."""
    dictionary, found = read_dictionary(spark, path), {}
    shards = spark.read.parquet(f"{path}/shards")
    wanted = F.lit(False)
    for doc_id in doc_ids:
        wanted |= F.coalesce(F.col("first_id") <= doc_id, F.lit(True)) & (F.col("last_id") >= doc_id)
    for row in shards.filter(wanted).select("blob").toLocalIterator():
        shard = Shard(bytes(row["blob"]), dictionary)
        for doc_id in doc_ids:
            for i in shard.find(doc_id):
                found[doc_id] = shard.ids(i).tolist()
    return found
