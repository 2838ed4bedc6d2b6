"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled as good; everything else, whatever its
label, is unlabelled web text. The class prior is estimated first: a classifier
of positives against unlabelled text orders the texts, and the share of unlabelled
texts above a threshold over the share of held-back positives above it levels off
at the prior where positives are alone. The threshold is the one whose ratio has
the lowest upper confidence bound, so neither a linear classifier nor a small
sample pulls the estimate up. The unlabelled share is counted over all rows.
Then a linear model on hashed character n-grams and shares of byte classes and repeats
minimises the non-negative unbiased risk
``prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)])`` in mini-batches; where
the second part falls under a tolerance, a small step back is taken.

The two classifiers are fitted on bounded samples (``max_positive`` and
``max_unlabelled`` rows, the lowest hashes of their ids); every text is scored
whole, in Arrow batches, whatever its length.

Cases: a null text scores as an empty one, which has the model's offset alone. A
document labelled more than once is positive if any label is 1. Null labels and
null ids are not learned from. Repeated ids are sampled once. Equal texts have
equal scores; a score of exactly 0.5 counts as good. Without positives
or unlabelled text every score is 0.5. Other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.llm.common import ASCII_SPACE, count_matrix, hash_cut, sigmoid, small_batches, texts_of, with_columns
from txnguard.llm.linear import Adam, fit_logistic, unit_rows
from txnguard.llm.quality_rules import repeated_words

SIZES = (1, 2)
BUCKETS = 1 << 9
GRAM_WEIGHT, SHAPE_WEIGHT = 0.5, 2.0
# byte classes whose share of a text is a feature
CLASSES = (bytes(range(65, 91)), b"#*$%&|<>@^~=+_{}[]\\/`", b"!?", b"0123456789")
WIDTH = BUCKETS + len(CLASSES) + 2


@dataclass
class QualityModel:
    weights: np.ndarray
    offset: float
    prior: float


def features(texts: list[str]) -> np.ndarray:
    """Hashed character n-grams, then the square roots of shares: byte classes, repeated lines, words in repeated windows."""
    raw = [t.encode() for t in texts]
    words = [r.split() for r in raw]
    lines = [[x for x in r.split(b"\n") if x.strip(ASCII_SPACE)] for r in raw]
    size = np.maximum(1, [len(r) for r in raw])
    shape = [np.array([len(r) - len(r.translate(None, c)) for r in raw]) / size for c in CLASSES]
    shape.append(np.array([1 - len(set(x)) / max(1, len(x)) if x else 0.0 for x in lines]))
    shape.append(repeated_words(words) / np.maximum(1, [len(w) for w in words]))
    return np.hstack([GRAM_WEIGHT * unit_rows(count_matrix(texts, SIZES, BUCKETS)), SHAPE_WEIGHT * np.sqrt(np.column_stack(shape))]).astype(np.float32)


def order_model(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """A linear order of texts, positives first (weights and offset), and the held-back positives' places in it, the highest first."""
    half = max(1, len(positive) // 2)
    seen, kept = positive[:half], positive[half:] if len(positive) > 1 else positive
    x = np.vstack([seen, unlabelled])
    y = np.r_[np.ones(len(seen)), np.zeros(len(unlabelled))]
    weight = np.where(y > 0, len(x) / (2 * len(seen)), len(x) / (2 * len(unlabelled)))
    w, b = fit_logistic(x, y, weight, epochs=40, rate=0.05, l2=1e-4)
    return w, b, np.sort(kept @ w + b)[::-1]


def prior_of_tails(above: np.ndarray, unlabelled: int, doubt: float = 0.1, margin: float = 0.01) -> float:
    """Share of positives in the unlabelled rows: ``above[i]`` of them lie at or over the i-th highest held-back positive.
    Both shares are off by the Dvoretzky-Kiefer-Wolfowitz bound at most, with probability 1 - ``doubt``."""
    positive = np.arange(1, len(above) + 1) / len(above)
    share = above / max(1, unlabelled)
    off = sum(np.sqrt(np.log(4 / doubt) / (2 * max(1, n))) for n in (len(above), unlabelled))
    best = np.argmin((share + (1 + margin) * off) / positive)
    return float(np.clip(share[best] / positive[best], 0.02, 0.98))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The prior from feature rows alone: half of the unlabelled ones fit the order, the others are counted."""
    half = len(unlabelled) // 2
    mixed = unlabelled[np.random.default_rng(3).permutation(len(unlabelled))]
    w, b, kept = order_model(positive, mixed[:half] if half else mixed)
    scores = np.sort(mixed[half:] @ w + b)
    return prior_of_tails(len(scores) - np.searchsorted(scores, kept), len(scores))


def counted_prior(pool: DataFrame, positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The prior with the unlabelled share counted over every row of ``pool``: tasks add up how many texts fall between
    two held-back positives, at most ``len(positive)`` numbers each."""
    w, b, kept = order_model(positive, unlabelled)
    low = kept[::-1].copy()
    shared = pool.sparkSession.sparkContext.broadcast((w, b, low))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b, low = shared.value
        n = np.zeros(len(low) + 1, dtype=np.int64)
        for batch in small_batches(batches):
            n += np.bincount(np.searchsorted(low, features(texts_of(batch)) @ w + b, side="right"), minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["place", "n"])

    got = pool.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(len(low) + 1, dtype=np.int64)
    n[got["place"].to_numpy()] = got["n"].to_numpy()
    return prior_of_tails(np.cumsum(n[::-1])[:-1], int(n.sum()))


def fit_pu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 60, rate: float = 0.03, l2: float = 1e-3, seed: int = 11, back: float = 0.1, tolerance: float = 0.05
) -> QualityModel:
    """Minimise the non-negative unbiased risk under the logistic loss; ``back`` weighs the step that is taken
    instead where the negative part of a batch is under -``tolerance``."""
    w, b = np.zeros(positive.shape[1], dtype=np.float32), np.zeros(1, dtype=np.float32)
    adam, rng = Adam([w, b], rate), np.random.default_rng(seed)
    steps = max(1, len(unlabelled) // 256)
    for _ in range(epochs):
        p_parts = np.array_split(rng.permutation(len(positive)), steps)
        u_parts = np.array_split(rng.permutation(len(unlabelled)), steps)
        for p_at, u_at in zip(p_parts, u_parts):
            if not len(p_at) or not len(u_at):
                continue
            xp, xu = positive[p_at], unlabelled[u_at]
            sp, su = sigmoid(xp @ w + b), sigmoid(xu @ w + b)
            # l(+) = log(1 + e^-f), l(-) = log(1 + e^f)
            negative = -np.log1p(-np.minimum(su, 1 - 1e-7)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-7)).mean()
            gp, gu = prior * (sp - 1) / len(p_at), np.zeros(len(u_at))
            if negative >= -tolerance:
                gp, gu = gp - prior * sp / len(p_at), su / len(u_at)
            else:  # the unbiased part went below zero: step back from it
                gp, gu = back * prior * sp / len(p_at), -back * su / len(u_at)
            grad = xp.T @ gp.astype(np.float32) + xu.T @ gu.astype(np.float32)
            adam.step([grad + l2 * w, np.array([gp.sum() + gu.sum()], dtype=np.float32)])
    return QualityModel(w, float(b[0]), prior)


def sample_features(docs: DataFrame, labels: DataFrame, train: Column, max_positive: int, max_unlabelled: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of the sampled positives and of the sampled unlabelled texts."""
    good_key, free_key = F.xxhash64("doc_id", F.lit("positive")), F.xxhash64("doc_id", F.lit("unlabelled"))
    good = labels.where(train & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1").select(good_key.alias("k"))
    pool = docs.where(train & F.col("doc_id").isNotNull())
    p_cut, u_cut = hash_cut(good, max_positive), hash_cut(pool.select(free_key.alias("k")), max_unlabelled)
    if p_cut is None or u_cut is None:
        return np.zeros((0, WIDTH), np.float32), np.zeros((0, WIDTH), np.float32)
    chosen = good.where(F.col("k") <= p_cut)  # at most max_positive rows
    rows = pool.select(good_key.alias("k"), (free_key <= u_cut).alias("free"), "text").join(F.broadcast(chosen.withColumn("good", F.lit(True))), "k", "left")
    rows = rows.select("k", F.coalesce("good", F.lit(False)).alias("good"), "free", "text").where("good or free")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            x = features(texts_of(batch)).astype("<f4")
            yield with_columns(batch, {"x": pa.array([row.tobytes() for row in x], pa.binary())}, drop={"text"})

    got = rows.mapInArrow(counts, "k long, good boolean, free boolean, x binary").dropDuplicates(["k"]).orderBy("k").limit(max_positive + max_unlabelled).toPandas()
    x = np.frombuffer(b"".join(got["x"]), dtype="<f4").reshape(len(got), WIDTH)
    return x[got["good"].to_numpy(bool)], x[got["free"].to_numpy(bool)]


def fit(docs: DataFrame, labels: DataFrame, train: Column, max_positive: int = 2000, max_unlabelled: int = 4000) -> QualityModel:
    positive, unlabelled = sample_features(docs, labels, train, max_positive, max_unlabelled)
    if not len(positive) or not len(unlabelled):
        return QualityModel(np.zeros(WIDTH, np.float32), 0.0, 0.5)
    pool = docs.where(train & F.col("doc_id").isNotNull())
    return fit_pu(positive, unlabelled, counted_prior(pool, positive, unlabelled))


def score(docs: DataFrame, model: QualityModel, keep: list[str]) -> DataFrame:
    """``keep`` of every row with ``score``, the probability that the text is good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in small_batches(batches):
            p = sigmoid((features(texts_of(batch)) @ m.weights + m.offset).astype(np.float64))
            yield with_columns(batch, {"score": pa.array(p, pa.float64())}, drop=set(batch.schema.names) - set(keep))

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)
