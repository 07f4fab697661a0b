"""BPE and token files: exact round trips against the libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from obsloom.llm import byte_bpe, token_files
from obsloom.session import work_path
from tables import prose

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "É", "é", "́", "'s", "'", "t", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", " ", "1", "20", ".", "İ",
          "ß", "Σ", "漢", "🙂", "‍", "\x01", "<|endoftext|>", "<|startoftext|>", "the", " of"]


def mixed_texts(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 18))) for _ in range(n)]


@pytest.fixture(scope="module")
def bpe():
    tokens = byte_bpe.read_ranks(RANKS)
    return byte_bpe.ByteBpe(byte_bpe.tokenizer_json(tokens, PATTERN), tokens)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_offsets_and_bytes(bpe, reference):
    texts = mixed_texts(4000)
    for text, ids in zip(texts, bpe.encode(texts)):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert bpe.decode(ids) == text
        starts = bpe.offsets(text, ids)
        assert starts[-1] == len(text) and (np.diff(starts) >= 0).all()
        for k in range(len(ids)):
            piece = bpe.tokens[ids[k]].decode("utf-8", errors="ignore")
            assert not piece or text[starts[k] : starts[k + 1] + 1].find(piece[0]) >= 0


def test_a_split_character_is_whole_only_with_its_other_half(bpe):
    (ids,) = bpe.encode(["🙂"])
    assert len(ids) > 1 and bpe.decode(ids) == "🙂" and "�" in bpe.decode(ids[:1])
    assert bpe.offsets("🙂", ids).tolist() == [0] * len(ids) + [1]


def test_long_texts_are_cut_where_no_match_crosses(bpe, reference):
    rng = random.Random(3)
    text = "".join(rng.choices(PIECES + [" "] * 10 + ["word"] * 10, k=4000))
    cuts = byte_bpe.pieces(text, limit=50)
    assert "".join(cuts) == text and len(cuts) > 5
    assert [i for c in cuts for i in reference.encode_ordinary(c)] == reference.encode_ordinary(text)
    assert byte_bpe.pieces("x" * 500, limit=50) == ["x" * 500]


def test_encode_and_decode_tables(spark):
    texts = mixed_texts(60)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    encoded = byte_bpe.encode_documents(docs, RANKS, PATTERN)
    decoded = {r["doc_id"]: r["text"] for r in byte_bpe.decode_ids(encoded, RANKS, PATTERN).collect()}
    assert decoded == dict(enumerate(texts))
    for r in byte_bpe.round_trip(docs, RANKS, PATTERN).collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_words_encode_like_whole_texts():
    with open(WORDS, encoding="utf-8") as file:
        json = file.read()
    library, encoder = Tokenizer.from_str(json), token_files.WordEncoder(json, 2)
    for text in mixed_texts(3000, seed=7):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == want
    encoder.known = {"": b""}
    token_files.REMEMBERED, kept = 3, token_files.REMEMBERED
    assert encoder.encode(["a b c d e", "a f"]) == token_files.WordEncoder(json, 2).encode(["a b c d e", "a f"])
    token_files.REMEMBERED = kept


def test_files_read_back(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i * 7 - 300, prose(rng, rng.randint(0, 60))) for i in range(400)]
    rows += [(5_000, None), (5_000, "repeated id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    path = work_path(spark, "tokens")
    token_files.write_token_files(docs, path, WORDS)
    library = Tokenizer.from_file(WORDS)
    got = sorted(map(tuple, token_files.read_token_files(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got][:2] == [None, -300] and [r[0] for r in got][1:] == sorted(r[0] for r in got[1:])
    ids_of: dict = {}
    for doc_id, text in rows:
        ids_of.setdefault(doc_id, []).append(np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4"))
    at = 0
    for doc_id, start, n_tokens, crc in got:
        assert start == at and any(len(i) == n_tokens and zlib.crc32(i.tobytes()) == crc for i in ids_of[doc_id])
        at += n_tokens
    assert token_files.lookup(spark, path, [-300, 8, 100]) == {-300: ids_of[-300][0].tolist(), 8: ids_of[8][0].tolist()}
    with pytest.raises(ValueError):
        token_files.Shard(bytes(spark.read.parquet(f"{path}/shards").first()["blob"]), b"another dictionary")
