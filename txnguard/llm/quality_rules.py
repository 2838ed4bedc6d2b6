"""Quality rules: base counts of every text, and a learned rule on top.

The learned rule is a logistic regression over hashed character and word
n-grams, trained on a bounded sample of labelled rows (``max_rows``, the lowest
hashes of their ids, brought to the driver as sparse rows), Platt-calibrated on rows kept out of its training, and
compared with a fixed threshold in Arrow batches.

Cases: a null text has no words, so it fails the base rule. Lines are equal as
they stand, blanks included; a line without a word is never a duplicate. Without
labelled rows of both classes the learned rule keeps all. A document labelled
more than once counts as good if any label is 1. Null ids and null labels are
not learned from. Windows of words are compared by 64-bit hashes within a text.
Repeated rows are judged each for itself, and sampled once; a probability at the
threshold is kept. Texts of any length are read whole. Other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import ASCII_SPACE, count_matrix, hash_cut, sigmoid, small_batches, texts_of, with_columns
from txnguard.llm.linear import SparseRows, fit_logistic, packed, platt, unit_rows

CHAR_SIZES = (1, 2, 3)
CHAR_BUCKETS = WORD_BUCKETS = 1 << 12
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5


@dataclass
class RuleModel:
    weights: np.ndarray
    offset: float
    slope: float  # of the calibration
    shift: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (x @ self.weights + self.offset).astype(np.float64) + self.shift)


def word_matrix(words: list[list[bytes]]) -> np.ndarray:
    """Dense (texts x buckets) counts of hashed single words and word pairs."""
    counts = np.array([len(w) for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), counts)
    h = np.array([zlib.crc32(w) for own in words for w in own], dtype=np.int64)
    same = owner[1:] == owner[:-1]
    pair = (h[:-1] * 0x9E3779B1 ^ h[1:])[same] if len(h) else h
    at = np.concatenate([owner * WORD_BUCKETS + h % WORD_BUCKETS, owner[1:][same] * WORD_BUCKETS + (pair >> 7) % WORD_BUCKETS])
    return np.bincount(at, minlength=len(words) * WORD_BUCKETS).reshape(len(words), WORD_BUCKETS)


def features(texts: list[str], words: list[list[bytes]]) -> np.ndarray:
    return np.hstack([unit_rows(count_matrix(texts, CHAR_SIZES, CHAR_BUCKETS)), unit_rows(word_matrix(words))])


def repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """Per text, the words that lie in a 5-word window found twice or more in it."""
    counts = np.array([len(w) for w in words], dtype=np.int64)
    total = int(counts.sum())
    out = np.zeros(len(words), dtype=np.int64)
    if total < REPEAT_WINDOW:
        return out
    owner = np.repeat(np.arange(len(words)), counts)
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for own in words for w in own), dtype=np.uint64, count=total)
    n = total - REPEAT_WINDOW + 1
    key = owner[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(REPEAT_WINDOW):
        key = (key ^ h[j : j + n]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    at = np.flatnonzero(owner[:n] == owner[REPEAT_WINDOW - 1 :])
    _, back, times = np.unique(key[at], return_inverse=True, return_counts=True)
    at = at[times[back] > 1]
    edge = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + REPEAT_WINDOW, -1)
    return np.bincount(owner[np.cumsum(edge[:-1]) > 0], minlength=len(words))


def base_counts(texts: list[str], words: list[list[bytes]]) -> dict[str, np.ndarray]:
    raw = [t.encode() for t in texts]
    lines = [[x for x in t.split(b"\n") if x.strip(ASCII_SPACE)] for t in raw]
    return {
        "n_words": np.array([len(w) for w in words], dtype=np.int64),
        "word_chars": np.array([len(t) - (len(r) - len(r.translate(None, ASCII_SPACE))) for t, r in zip(texts, raw)], dtype=np.int64),
        "n_symbols": np.array([len(r) - len(r.translate(None, SYMBOLS)) for r in raw], dtype=np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64),
        "n_repeat_words": repeated_words(words),
    }


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000) -> RuleModel | None:
    own = F.xxhash64("doc_id", F.lit("rules"))
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).select(own.alias("k"), "quality")
    cut = hash_cut(marked.select("k"), max_rows)
    if cut is None:
        return None
    rows = docs.where("doc_id is not null").select(own.alias("k"), "text").join(F.broadcast(marked.where(F.col("k") <= cut)), "k")  # at most max_rows rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = texts_of(batch)
            x = features(texts, [t.encode().split() for t in texts])
            yield with_columns(batch, {"x": pa.array([packed(row) for row in x], pa.binary())}, drop={"text"})

    got = rows.select("k", F.col("quality").cast("int").alias("quality"), "text").mapInArrow(run, "k long, quality int, x binary").dropDuplicates(["k"]).orderBy("k").limit(max_rows).toPandas()
    y = got["quality"].to_numpy()
    x = SparseRows(list(got.pop("x")), CHAR_BUCKETS + WORD_BUCKETS)
    held = np.arange(len(y)) % 4 == 3
    if not all(0 < y[part].sum() < part.sum() for part in (held, ~held)):
        held = np.zeros(len(y), dtype=bool)
    if not 0 < y.sum() < len(y):
        return None
    w, b = fit_logistic(x.only(~held), y[~held].astype(np.float32))
    part = held if held.any() else ~held
    return RuleModel(w, b, *platt((x.only(part) @ w + b).astype(np.float64), y[part]))


def apply(docs: DataFrame, model: RuleModel | None, threshold: float = 0.5, min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the calibrated probability of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = texts_of(batch)
            words = [t.encode().split() for t in texts]
            base = base_counts(texts, words)
            failed = (base["n_words"] < min_words) | (100 * base["n_repeat_words"] > max_repeat_percent * base["n_words"])
            p = np.ones(len(texts)) if shared.value is None else shared.value.probability(features(texts, words))
            new = {k: pa.array(v, pa.int64()) for k, v in base.items()}
            new |= {"base_failed": pa.array(failed, pa.bool_()), "kept": pa.array(~failed & (p >= threshold), pa.bool_()), "probability": pa.array(p, pa.float64())}
            yield with_columns(batch, new, drop={"text"})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double")
