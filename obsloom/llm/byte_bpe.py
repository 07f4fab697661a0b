"""Byte-level BPE with the tokenizers library, over Arrow batches.

The library works on characters, so every byte is mapped to a printable character first; the ranks of a
rank file become its vocabulary and merges. Offsets come from the bytes of each id: running sums give byte
places, and the count of bytes that begin a character maps them to characters. Decoding reverses the byte
table and joins bytes before it reads characters, so an id may end inside one.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, SparkContext
from pyspark.sql import DataFrame, SparkSession

from obsloom.llm.texts import pick

#: Characters that are encoded at once; what the library keeps for them bounds a task's memory.
CHUNK = 1 << 19
#: Words whose ids a process remembers, and what is cut off behind a word.
REMEMBERED = 500_000
TAIL = ".,;:!?"


def byte_characters() -> list[str]:
    """The character of each byte: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Bytes of each id of a rank file (base64 bytes and rank in each line, ranks without gaps)."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def halves(token: bytes, rank: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The last merge that makes ``token``: merge its bytes by ranks below its own until two parts are left."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        pairs = [(rank.get(parts[i] + parts[i + 1], len(rank)), i) for i in range(len(parts) - 1)]
        _, i = min(p for p in pairs if p[0] != rank[token])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def tokenizer_json(tokens: list[bytes], pattern: str) -> str:
    """A byte-level BPE of the tokenizers library for the ranks; no special tokens."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    table = byte_characters()
    spell = lambda token: "".join(table[b] for b in token)
    rank = {token: i for i, token in enumerate(tokens)}
    merges = [tuple(map(spell, halves(token, rank))) for token in tokens if len(token) > 1]
    model = models.BPE(vocab={spell(t): i for t, i in rank.items()}, merges=merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return tokenizer.to_str()


def pieces(text: str, limit: int = CHUNK) -> list[str]:
    """Cuts of a long text where no match can cross: before a single space between two other characters."""
    found, start = [], 0
    while len(text) - start > limit:
        cut = text.find(" ", start + limit)
        while 0 <= cut < len(text) - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if not 0 <= cut < len(text) - 1:
            break
        found.append(text[start:cut])
        start = cut
    return [*found, text[start:]]


def split_tail(word: str) -> tuple[str, str]:
    """A word and the full stops and commas after it; no match of either tokenizer's pattern spans the two."""
    core = word.rstrip(TAIL)
    return (core, word[len(core) :]) if core and core[-1].lower().isalpha() else (word, "")


class ByteBpe:
    """Encoder and decoder of one process.

    A text is cut before single spaces between two other characters, where no match of the pattern can
    cross. The ids of these pieces are remembered, and new ones go to the library in one text.
    """

    def __init__(self, json: str, tokens: list[bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        self.library, self.tokens = Tokenizer.from_str(json), tokens
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.known: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        """Ids of a text as the library gives them, a bounded number of characters at a time."""
        parts = [self.library.encode_batch_fast([p], add_special_tokens=False)[0].ids for p in pieces(text)]
        return b"".join(np.array(p, dtype="<u4").tobytes() for p in parts)

    def _together(self, words: list[str]) -> None:
        """Learn words, each with a space before it; the bytes of the ids tell where one ends."""
        if not words:
            return
        joined = " " + " ".join(words)
        ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.cumsum([len(word.encode()) + 1 for word in words])
        cuts = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
        raw, start = ids.tobytes(), 0
        for word, cut in zip(words, (4 * cuts).tolist()):
            self.known[word] = raw[start:cut]
            start = cut

    def learn(self, words: Iterable[str]) -> None:
        split = [(word, *split_tail(word)) for word in words]
        batch, size = [], 0
        for core in {core for _, core, _ in split} - self.known.keys():
            batch.append(core)
            size += len(core)
            if size > CHUNK // 8:
                self._together(batch)
                batch, size = [], 0
        self._together(batch)
        for word, core, tail in split:
            if tail:
                self.known[word] = self.known[core] + self.tail(tail)

    def tail(self, text: str) -> bytes:
        """Ids of what follows a word without a space."""
        key = "\0" + text
        if key not in self.known:
            self.known[key] = self.plain(text)
        return self.known[key]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        split = [text.split(" ") for text in texts]
        # the first word has no space before it; a word that begins or ends with white space, or is empty
        # (two spaces), may share a match with its neighbours, and its text is encoded as a whole
        whole = [any(not w or w[0].isspace() or w[-1].isspace() or "\0" in w for w in words) for words in split]
        new = {w for words, plain in zip(split, whole) if not plain for w in words[1:]} - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = {w for words, plain in zip(split, whole) if not plain for w in words[1:]}
        self.learn(new)
        found = []
        for text, words, plain in zip(texts, split, whole):
            raw = self.plain(text) if plain else self.tail(words[0]) + b"".join(map(self.known.__getitem__, words[1:]))
            found.append(np.frombuffer(raw, dtype="<u4"))
        return found

    def offsets(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Character where each id begins, and at last the number of characters.

        An id that begins inside a character begins at that character.
        """
        places = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        begun = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        inside = np.concatenate([(raw & 0xC0) == 0x80, [False]])
        return begun[places] - inside[places]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; half characters at the ends of a slice become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


_MODELS: dict[str, object] = {}


def of_process(json: str, make: Callable[[], object]) -> object:
    """The one encoder that a Python process has for a tokenizer; later tasks find its words learned."""
    name = f"{make.__qualname__} {hashlib.sha256(json.encode()).hexdigest()}"
    if name not in _MODELS:
        _MODELS[name] = make()
    return _MODELS[name]


def byte_bpe(json: str, tokens: list[bytes]) -> ByteBpe:
    def new_byte_bpe() -> ByteBpe:
        return ByteBpe(json, tokens)

    return of_process(json, new_byte_bpe)


def shared(spark: SparkSession, ranks_path: str, pattern: str) -> Broadcast:
    """The tokenizer for the executors, a few megabytes that the vocabulary bounds; the file is read here only."""
    tokens = read_ranks(ranks_path)
    context: SparkContext = spark.sparkContext
    return context.broadcast((tokenizer_json(tokens, pattern), tokens))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text_offsets: bool = True, decoded: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, ids, offsets (starts in characters, and the length).

    With ``decoded`` also decoded_sha256, the hash of the bytes that the ids decode to.

    Null texts count as empty and have no ids; repeated rows give repeated rows; an empty table gives none;
    other columns are not looked at. Without ``text_offsets`` the offsets are null.
    """
    model = shared(docs.sparkSession, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(*model.value)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = bpe.encode(texts)
            places = [bpe.offsets(t, i) for t, i in zip(texts, ids)] if text_offsets else [None] * len(texts)
            columns = [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(places, pa.list_(pa.int64()))]
            if decoded:
                columns.append(pa.array([hashlib.sha256(bpe.decode_bytes(i)).hexdigest() for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "offsets", "decoded_sha256"][: len(columns)])

    schema = "doc_id long, ids array<int>, offsets array<long>" + (", decoded_sha256 string" if decoded else "")
    return pick(docs, "doc_id", "text").mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) to (doc_id, text); null ids give a null text."""
    model = shared(encoded.sparkSession, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(*model.value)
        for batch in slices(batches):
            texts = [None if i is None else bpe.decode(np.array(i, dtype=np.int64)) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pick(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, n_split, ids_sha256, decoded_sha256.

    ``n_split`` counts the ids that begin inside a character. The ids are hashed as little-endian unsigned
    32-bit integers, the decoded bytes as they are. Edge cases are those of ``encode_documents``.
    """
    model = shared(docs.sparkSession, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(*model.value)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for text, ids in zip(texts, bpe.encode(texts)):
                places = bpe.offsets(text, ids)
                decoded = bpe.decode_bytes(ids)
                n_split = 0 if text.isascii() else int((np.diff(places) == 0).sum())
                rows.append((len(ids), n_split, hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            n_tokens, n_split, ids_sha, text_sha = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(n_split, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                names=["doc_id", "n_tokens", "n_split", "ids_sha256", "decoded_sha256"],
            )

    return pick(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_split long, ids_sha256 string, decoded_sha256 string"
    )
