"""Language identification: multinomial naive Bayes over hashed character n-grams.

``fit`` counts n-grams per language over every labelled training text and writes
them, a packed row per language. ``detect`` scores Arrow batches: each text is a
sparse row of bucket counts, and its product with a log-probability matrix is a
gather, in chunks of bounded size, and a segmented sum. The matrix of at most
``block`` languages is broadcast; where a corpus has more, the blocks are scored one
after the other, and every row carries its best language and the log of the sum of
its posteriors on, which is exact for any number of languages.

Cases: a null text, or one without a letter, gets ``und`` and score 0. Texts of any
length are read whole. Null ``lang`` rows are not learned from. With nothing to learn
from, every text gets ``und``. Repeated rows count as often as they occur. Equal
posteriors go to the language that sorts first. Columns of the input named
``lang_pred`` or ``score`` are replaced by the result; all others pass through. An
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.llm.common import char_ngrams, free_name, materialize, small_batches, texts_of, with_columns

UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]")
_GATHER = 1 << 22  # entries of the matrix that are gathered at a time


def has_letter(text: str) -> bool:
    """Whether a character is a letter; numerals that the regular expression takes for one are none."""
    return any(m[0].isalpha() for m in _WORD.finditer(text))


@dataclass
class Block:
    """Some languages, one after the other in the model's order."""

    names: list[str]
    log_prior: np.ndarray  # per language
    log_prob: np.ndarray  # buckets x languages, so that one n-gram is one contiguous row
    sizes: tuple[int, ...]


@dataclass
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    table: DataFrame | None  # (lang, entries: bucket and count) of every language
    sizes: tuple[int, ...]
    buckets: int
    smoothing: float
    block: int

    def blocks(self) -> Iterator[Block]:
        for lo in range(0, len(self.languages), self.block):
            names = self.languages[lo : lo + self.block]
            got = self.table.where(F.col("lang").between(names[0], names[-1])).toArrow()
            table = np.full((self.buckets, len(names)), self.smoothing)
            place = {x: i for i, x in enumerate(names)}
            for lang, own in zip(got.column("lang").to_pylist(), got.column("entries").combine_chunks()):
                bucket, n = (own.values.field(f).to_numpy() for f in ("bucket", "n"))
                table[bucket[bucket >= 0], place[lang]] += n[bucket >= 0]
            yield Block(names, self.log_prior[lo : lo + self.block], np.log(table / table.sum(axis=0, keepdims=True)), self.sizes)


def fit(docs: DataFrame, train: Column, sizes: tuple[int, ...] = (1, 2, 3), buckets: int = 1 << 15, smoothing: float = 0.5, block: int = 64) -> LanguageModel:
    """Learn from ``text`` and non-null ``lang`` of the rows where ``train`` holds. The driver gets the languages' names and
    text counts, and the counts of ``block`` languages at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for name, own in totals.items():
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(own[at], rows[name]), pa.int64())],
                    names=["lang", "bucket", "n"],
                )

        for batch in small_batches(batches, max_rows=block):  # so many languages at most in a slice
            langs = batch.column("lang").to_pylist()
            names = sorted(set(langs))
            code = {x: i for i, x in enumerate(names)}
            of = np.array([code[x] for x in langs], dtype=np.int64)
            got = np.zeros((len(names), buckets), dtype=np.int64)
            for owner, bucket in char_ngrams(texts_of(batch), sizes, buckets):
                got += np.bincount(of[owner] * buckets + bucket, minlength=got.size).reshape(got.shape)
            if len(totals.keys() | set(names)) > 2 * block:
                yield from told()
                totals.clear()
                rows.clear()
            for name, own in zip(names, got):
                totals[name] = totals[name] + own if name in totals else own
                rows[name] = rows.get(name, 0) + langs.count(name)
        yield from told()

    labelled = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text")
    counts = labelled.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # a language has an entry per bucket at most, and one (bucket -1) for its texts
    packed = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("entries"), F.sum(F.when(F.col("bucket") < 0, F.col("n"))).alias("texts"))
    table = materialize(packed, "languages")
    known = sorted((r["lang"], r["texts"]) for r in table.select("lang", "texts").collect())
    texts = np.array([n for _, n in known], dtype=float)
    return LanguageModel([x for x, _ in known], np.log(texts / texts.sum()) if known else texts, table, sizes, buckets, smoothing, block)


def log_posteriors(texts: list[str], block: Block) -> np.ndarray:
    """(texts x languages) of a block, up to a constant per text."""
    total = np.tile(block.log_prior, (len(texts), 1))
    step = max(1, _GATHER // len(block.names))
    for owners, buckets in char_ngrams(texts, block.sizes, len(block.log_prob)):
        for lo in range(0, len(owners), step):
            owner, bucket = owners[lo : lo + step], buckets[lo : lo + step]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            np.add.at(total, owner[first], np.add.reduceat(block.log_prob[bucket], first, axis=0))
    return total


def _judged(docs: DataFrame, model: LanguageModel, finish: Callable, schema: T.StructType) -> DataFrame:
    """``finish(batch, languages, posteriors)`` of the rows of ``docs``, which have ``text``."""
    spark, own = docs.sparkSession, docs.schema
    state = []
    for name in ("best", "most", "sum"):
        state.append(free_name(docs, f"_{name}"))
    fields = [T.StructField(n, t) for n, t in zip(state, (T.StringType(), T.DoubleType(), T.DoubleType()))]
    n_blocks = -(-len(model.languages) // model.block)

    def step(shared, first: bool, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in small_batches(batches):
                texts = texts_of(batch)
                plain = batch.select(own.names)
                if not block.names:
                    yield finish(plain, [UNDETERMINED] * len(texts), np.zeros(len(texts)))
                    continue
                total = log_posteriors(texts, block)
                at, most = total.argmax(axis=1), total.max(axis=1)
                best, summed = [block.names[i] for i in at], most + np.log(np.exp(total - most[:, None]).sum(axis=1))
                if not first:
                    before, m, s = batch.column(state[0]).to_pylist(), *(batch.column(c).to_numpy() for c in state[1:])
                    best = [b if keep else x for b, x, keep in zip(before, best, m >= most)]
                    most, summed = np.maximum(m, most), np.logaddexp(s, summed)
                if not last:
                    yield with_columns(plain, dict(zip(state, (pa.array(best, pa.string()), pa.array(most), pa.array(summed)))))
                    continue
                lettered = np.array([has_letter(t) for t in texts], dtype=bool)
                score = np.where(lettered, np.exp(np.minimum(most - summed, 0.0)), 0.0)
                yield finish(plain, [b if ok else UNDETERMINED for b, ok in zip(best, lettered)], score)

        return run

    rows = docs
    for k, block in enumerate(model.blocks() if n_blocks else [Block([], np.zeros(0), np.zeros((0, 0)), model.sizes)]):
        last = k >= n_blocks - 1
        rows = rows.mapInArrow(step(spark.sparkContext.broadcast(block), k == 0, last), schema if last else T.StructType([*own.fields, *fields]))
        if not last:
            rows = materialize(rows, "language_block")
    return rows


def detect(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) of every row, with ``lang_pred`` and ``score``."""
    new = ["lang_pred", "score"]
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]

    def finish(batch: pa.RecordBatch, langs: list[str], score: np.ndarray) -> pa.RecordBatch:
        return with_columns(batch, {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(score, pa.float64())}, drop=set(batch.schema.names) - set(keep))

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return _judged(docs.select(*dict.fromkeys([*keep, "text"])), model, finish, schema)


def accepted(docs: DataFrame, model: LanguageModel, min_score: float = 0.5) -> DataFrame:
    """The rows, with their own columns, whose language the model can tell: not ``und``, posterior at least ``min_score``."""

    def finish(batch: pa.RecordBatch, langs: list[str], score: np.ndarray) -> pa.RecordBatch:
        return batch.filter(pa.array([x != UNDETERMINED and s >= min_score for x, s in zip(langs, score)], pa.bool_()))

    return _judged(docs, model, finish, docs.schema)
