"""Language by mixture inference over character trigrams.

Training counts hashed trigrams of every labelled document. A document is a mixture of languages: expectation
maximisation finds the proportions under which its trigrams are likeliest. Of the nested sets of its leading
languages the one with the best penalised likelihood stays, and its largest proportion names the language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.llm.byte_bpe import slices
from obsloom.llm.texts import pick

#: Trigrams are hashed to so many buckets; with the number of labels this bounds the model.
BUCKETS = 1 << 16
SMOOTHING = 0.5
#: Rounds of expectation maximisation, and the price of one more language
#: in units of the logarithm of the document's trigrams (trigrams overlap, so more than the usual half).
ROUNDS, PRICE = 12, 2.0
#: Proportion among all languages from which on a language may be in a set; the largest always may.
LEAST_SHARE = 0.01
UNKNOWN = "und"

_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of the trigrams of lower-case letters, where every run of other characters is one space.

    A text without letters has none.
    """
    codes = np.frombuffer("\0".join(["", *[t.replace("\0", " ").lower() for t in texts], ""]).encode("utf-32-le", "replace"), dtype="<u4")
    owner = np.cumsum(codes == 0) - 1
    code = np.where(letters()[np.minimum(codes, 0x10FFFF)], codes, 0).astype(np.uint64)
    # One space between runs of letters: a place stays if it is a letter or follows one, or begins a text.
    spoken = code != 0
    begins = np.concatenate([[True], np.diff(owner) > 0])
    stays = spoken | np.concatenate([[True], spoken[:-1]]) | begins
    code, owner, begins = code[stays], owner[stays], begins[stays]
    if len(code) < 3:
        return (np.zeros(0, dtype=np.int64),) * 3
    a, b, c = code[:-2], code[1:-1], code[2:]
    mixed = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + c * np.uint64(0x165667B19E3779F9)
    bucket = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)
    holds = (b != 0) | (a != 0) & (c != 0)
    own = owner[1:-1]
    inside = holds & ~begins[1:-1] & (own < len(texts))
    pair, count = np.unique(own[inside] * BUCKETS + bucket[inside], return_counts=True)
    return pair // BUCKETS, pair % BUCKETS, count


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that training leaves out; a null identifier is not one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        text, lang = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for label in set(lang):
            _, bucket, count = trigrams([t or "" for t, own in zip(text, lang) if own == label])
            own = totals.setdefault(label, np.zeros(BUCKETS, dtype=np.int64))
            own += np.bincount(bucket, weights=count, minlength=BUCKETS).astype(np.int64)
    for label, own in totals.items():
        (bucket,) = np.nonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([label] * len(bucket), pa.string()), pa.array(bucket, pa.int32()), pa.array(own[bucket], pa.int64())],
            names=["lang", "bucket", "n"],
        )


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log likelihoods (language, bucket), from all rows (text, lang) with a label.

    What comes to the driver is one number per language and bucket.
    """
    rows = pick(labelled, "text", "lang").filter("lang is not null")
    counted = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    names = sorted(table["lang"].unique())
    counts = np.full((len(names), BUCKETS), SMOOTHING)
    place = {name: i for i, name in enumerate(names)}
    np.add.at(counts, (table["lang"].map(place).to_numpy(dtype=int), table["bucket"].to_numpy(dtype=int)), table["n"].to_numpy())
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32) if names else counts


def _per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def proportions(likelihood: np.ndarray, count: np.ndarray, group: np.ndarray, starts: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixture proportions (text, language) from ``begin`` on, and the log likelihood of each text under them."""
    mix, total = begin, _per_text(count, starts)[:, None]
    for _ in range(ROUNDS):
        share = mix[group] * likelihood
        share *= (count / share.sum(axis=1))[:, None]
        mix = _per_text(share, starts) / total
    fit = _per_text(count * np.log((mix[group] * likelihood).sum(axis=1)), starts)
    return mix, fit


def infer(texts: list[str], model: np.ndarray) -> np.ndarray:
    """Proportions (text, language) of the chosen set of each text; all zero without letters."""
    out = np.zeros((len(texts), len(model)))
    owner, bucket, count = trigrams(texts)
    if not len(owner) or not len(model):
        return out
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [len(owner)]])))
    count = count.astype(np.float64)
    logs = model[:, bucket].T.astype(np.float64)
    most = len(model)
    # The languages that explain a text best alone come first, which settles ties; all of them are mixed.
    alone = _per_text(logs * count[:, None], starts)
    leading = np.argsort(-alone, axis=1, kind="stable")
    logs = np.take_along_axis(logs, leading[group], axis=1)
    likelihood = np.exp(logs - logs.max(axis=1, keepdims=True)) + 1e-300
    mix, _ = proportions(likelihood, count, group, starts, np.full((len(starts), most), 1.0 / most))
    # From here on the languages of a text go by their proportion, and those with a share too small are out.
    order = np.argsort(-mix, axis=1, kind="stable")
    sizes = np.maximum((mix >= LEAST_SHARE).sum(axis=1), 1)
    price = PRICE * np.log(_per_text(count, starts) + 1)
    best, best_fit = np.zeros_like(mix), np.full(len(starts), -np.inf)
    for size in range(1, int(sizes.max()) + 1):
        texts = np.flatnonzero(sizes >= size)  # the few texts that have so many languages
        rows = np.flatnonzero(sizes[group] >= size)
        own_group = np.searchsorted(texts, group[rows])
        own_starts = np.flatnonzero(np.concatenate([[True], own_group[1:] != own_group[:-1]]))
        chosen = order[texts, :size]
        part = np.take_along_axis(likelihood[rows], chosen[own_group], axis=1)
        own, fit = proportions(part, count[rows], own_group, own_starts, np.full((len(texts), size), 1.0 / size))
        fit = fit - price[texts] * (size - 1)
        better = np.flatnonzero(fit > best_fit[texts])
        best_fit[texts[better]] = fit[better]
        best[texts[better]] = 0.0
        best[texts[better][:, None], chosen[better]] = own[better]
    np.put_along_axis(rows := np.zeros((len(starts), len(model))), leading, best, axis=1)
    out[owner[starts]] = rows
    return out


def predict(docs: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, lang_pred, score, languages.

    ``score`` is the proportion of the predicted language, ``languages`` names the chosen set by proportion.
    Texts that are null or without a letter get ``und`` and 0, and so does every text without a trained
    language. Ties go to the first language by name. An empty table gives no rows; other columns are not
    looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast((names, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, table = shared.value
        for batch in slices(batches, 256):
            found = infer([t or "" for t in batch.column("text").to_pylist()], table)
            if not labels:
                found = np.zeros((batch.num_rows, 1))
            top, score = found.argmax(axis=1), np.clip(found.max(axis=1), 0.0, 1.0)
            sets = [[labels[i] for i in np.argsort(-row, kind="stable") if row[i] > 0.01] for row in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"),
                    pa.array([labels[i] if s > 0 else UNKNOWN for i, s in zip(top, score)], pa.string()),
                    pa.array(score, pa.float64()), pa.array(sets, pa.list_(pa.string())),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "languages"],
            )

    rows = pick(docs, "doc_id", "text").select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>")


def train_and_predict(docs: DataFrame) -> DataFrame:
    """``predict`` after training on the rows with a label that are not held out."""
    labelled = pick(docs, "doc_id", "text", "lang").filter(~held_out())
    return predict(docs, *train(labelled))
