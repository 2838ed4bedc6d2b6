"""Alignment of two tokenizers over the bytes of a text, by sparse incidence matrices.

Per Arrow batch, the tokens of both tokenizers are rows of token-by-byte incidence
matrices A and B in compressed sparse rows. Gustavson's row products give

* A·Bᵀ: the overlap links, with the bytes that two tokens share. Where no link
  spans from one token to the next, both tokenizers end, so the links cut the
  tokens into groups;
* the product of the tokens' group incidences: all links of tokens that share a
  group, taken over the distinct tokens of each group with their counts, in
  blocks of rows of bounded size.

The first pass writes each document's distinct linked pairs of ids, packed. The
documents that hold a pair are added up in the task, in the stage and by one
shuffle on the pair. The second pass looks the counts up: the most frequent pairs
in a broadcast of at most ``broadcast_pairs``, all others by a join on the pair.

Cases: a null or empty text has no tokens, as has one whose tokens do not spell
the text with a space before it (white space that the second tokenizer rewrites,
say): zeros and an empty digest. Texts of any length are read whole. Every row is
a document of its own, so repeated rows count twice and a null id is passed on.
Ties for the highest count of an id are all best. Other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.llm.common import byte_alphabet, materialize, small_batches, texts_of

_BLOCK = 1 << 21  # products of a block of rows
_FLUSH = 1 << 22  # pairs of documents that a task adds up at a time


# --- sparse rows ------------------------------------------------------------------------


@dataclass
class Csr:
    """A sparse matrix by rows: the columns of row i are ``cols[ptr[i]:ptr[i + 1]]``, ascending, with ``vals`` beside them."""

    ptr: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    width: int

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))
        order = np.argsort(self.cols, kind="stable")
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.cols, minlength=self.width))])
        return Csr(ptr, rows[order], self.vals[order], len(self.ptr) - 1)


def incidence(owner: np.ndarray, cols: np.ndarray, rows: int, width: int, vals: np.ndarray | None = None) -> Csr:
    """The matrix with ``vals`` (1) at (owner, cols); owner ascends, and cols within each."""
    ptr = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
    return Csr(ptr, cols, np.ones(len(cols), dtype=np.int64) if vals is None else vals, width)


def product(a: Csr, b: Csr, block: int = _BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, values) of a·b by Gustavson: a row of the product adds up the rows of b that a row of a names.
    Blocks of rows follow one another; each holds ``block`` single products or one entry of a at most."""
    many = np.diff(b.ptr)[a.cols]
    upto = np.concatenate([[0], np.cumsum(many)])
    row = np.repeat(np.arange(len(a.ptr) - 1), np.diff(a.ptr))
    lo = 0
    while lo < len(a.cols):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + block, side="right")) - 1)
        if hi < len(a.cols):  # whole rows, if one fits
            start = int(a.ptr[row[hi]])
            hi = start if start > lo else hi
        n = many[lo:hi]
        at = np.arange(int(upto[hi] - upto[lo])) + np.repeat(b.ptr[a.cols[lo:hi]] - (upto[lo:hi] - upto[lo]), n)
        key = np.repeat(row[lo:hi], n) * b.width + b.cols[at]
        val = np.repeat(a.vals[lo:hi], n) * b.vals[at]
        if len(key) and not (key[1:] >= key[:-1]).all():
            order = np.argsort(key, kind="stable")
            key, val = key[order], val[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        yield key[first] // b.width, key[first] % b.width, np.add.reduceat(val, first) if len(key) else val
        lo = hi


# --- tokens -----------------------------------------------------------------------------


@dataclass
class Vocabulary:
    encode: Callable[[list[str]], list]  # ids of texts with a space before them
    token: list[bytes]
    size: np.ndarray  # bytes of each token


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    """A byte-level BPE file. Its merges stand in the order of their results' ids (checked here), so the ids are ranks,
    which tiktoken takes several times faster than the file's own library; the results are the same."""
    import public_tokenizers
    import tiktoken

    spec = json.load(open(path, encoding="utf-8"))
    alphabet = byte_alphabet()
    special = {t["id"] for t in spec["added_tokens"] if t["special"]}
    ids = spec["model"]["vocab"]
    merged = [ids["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
    if sorted(merged) != merged or spec["normalizer"] or not spec["pre_tokenizer"]["use_regex"]:
        raise ValueError("not a byte-level BPE file whose ids are merge ranks")
    raw = {i: bytes(alphabet[c] for c in x) if i not in special else x.encode() for x, i in ids.items()}
    ranks = {x: i for i, x in raw.items() if i not in special}
    encoding = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    token = [raw.get(i, b"") for i in range(max(raw) + 1)]
    return Vocabulary(lambda texts: [encoding.encode_ordinary(" " + t) if t else [] for t in texts], token, np.array([len(t) for t in token]))


@lru_cache(maxsize=2)
def pieces(path: str) -> Vocabulary:
    """A sentencepiece model with byte fallback, which adds the space itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def raw(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else piece.replace("▁", " ").encode()

    token = [raw(i) for i in range(model.get_piece_size())]
    return Vocabulary(lambda texts: model.encode(texts, num_threads=1), token, np.array([len(t) for t in token]))


# --- links ------------------------------------------------------------------------------


def groups_of(size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token, given the bytes of the tokens that both spell one text: cut where no overlap link spans."""
    ends_a, ends_b, n = np.cumsum(size_a), np.cumsum(size_b), int(size_a.sum())
    bytes_of = lambda ends: Csr(np.concatenate([[0], ends]), np.arange(n), np.ones(n, dtype=np.int64), n)
    first = np.full(len(size_a), len(size_b), dtype=np.int64)
    last = np.zeros(len(size_a), dtype=np.int64)
    for row, col, _ in product(bytes_of(ends_a), bytes_of(ends_b).transposed()):
        edge = np.flatnonzero(row[1:] != row[:-1])
        start, end = np.append(0, edge + 1), np.append(edge, len(row) - 1)
        first[row[start]] = np.minimum(first[row[start]], col[start])  # a row over several blocks comes up in each
        last[row[end]] = col[end]
    new = np.ones(len(size_a), dtype=bool)
    new[1:] = first[1:] > last[:-1]
    group_a = np.cumsum(new) - 1
    start = first[new]  # the first of the other's tokens in each group
    return group_a, np.searchsorted(start, np.arange(len(size_b)), side="right") - 1


def _distinct(group: np.ndarray, ids: np.ndarray, groups: int, width: int) -> tuple[Csr, np.ndarray]:
    """Rows: the distinct (group, id), in order, each with its group as column and its count as value; and their ids."""
    key = group * width + ids
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    return Csr(np.arange(len(key) + 1), key // width, times, groups), key % width


def links(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, doc_of_group: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, links) of every distinct pair a * width + b that shares a group in a document, in order."""
    n = len(doc_of_group)
    rows, a = _distinct(group_a, ids_a, n, 1 << 32)
    cols, b = _distinct(group_b, ids_b, n, 1 << 32)
    doc, pair, times = (np.zeros(0, dtype=np.int64),) * 3
    for i, j, more in product(rows, cols.transposed()):
        own = doc_of_group[rows.cols[i]], a[i] * width + b[j], more
        doc, pair, times = _added(*own) if not len(doc) else _added(*(np.concatenate(x) for x in zip((doc, pair, times), own)))
    return doc, pair, times


def _added(doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sums of ``times`` over equal (doc, pair), in order."""
    span = int(pair.max()) + 1
    order = np.argsort(doc * span + pair) if span * (int(doc.max()) + 1) < 1 << 62 else np.lexsort((pair, doc))
    doc, pair, times = doc[order], pair[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])]))
    return doc[first], pair[first], np.add.reduceat(times, first)


@lru_cache(maxsize=1)
def _decimals(n: int) -> list[bytes]:
    return [x for i in range(n) for x in (b"%d," % i, b"%d|" % i, b"%d;" % i)]


def groups_text(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, upto: int) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group of one document, groups numbered from 0."""
    per_a, per_b = np.bincount(group_a), np.bincount(group_b)
    out = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    ends = lambda g: np.concatenate([g[1:] != g[:-1], [True]])
    out[np.arange(len(ids_a)) + (np.cumsum(per_b) - per_b)[group_a]] = 3 * ids_a + ends(group_a)
    out[np.arange(len(ids_b)) + np.cumsum(per_a)[group_b]] = 3 * ids_b + 2 * ends(group_b)
    return b"".join(map(_decimals(upto).__getitem__, out.tolist()))[:-1]


class Batch:
    """The tokens of some documents, one after the other: flat ids, the document of each, and their groups."""

    def __init__(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray], size_a: np.ndarray, size_b: np.ndarray):
        self.n_a, self.n_b = np.array([len(x) for x in ids_a], dtype=np.int64), np.array([len(x) for x in ids_b], dtype=np.int64)
        self.a, self.b = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (ids_a, ids_b))
        docs = np.arange(len(ids_a))
        self.doc_a, self.doc_b = np.repeat(docs, self.n_a), np.repeat(docs, self.n_b)
        if len(self.a):
            self.group_a, self.group_b = groups_of(size_a[self.a], size_b[self.b])
        else:
            self.group_a = self.group_b = np.zeros(0, dtype=np.int64)
        start = np.concatenate([[True], self.group_a[1:] != self.group_a[:-1]])[: len(self.a)]
        self.doc_of_group = self.doc_a[start]
        self.n_groups = np.bincount(self.doc_of_group, minlength=len(ids_a)) if len(self.a) else np.zeros(len(ids_a), dtype=np.int64)

    def links(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return links(self.a, self.b, self.group_a, self.group_b, self.doc_of_group, width)

    def texts(self, upto: int) -> Iterator[bytes]:
        ends_a, ends_b, ends_g = np.cumsum(self.n_a), np.cumsum(self.n_b), np.cumsum(self.n_groups)
        for ea, eb, eg, na, nb, ng in zip(*(x.tolist() for x in (ends_a, ends_b, ends_g, self.n_a, self.n_b, self.n_groups))):
            a, b, g = slice(ea - na, ea), slice(eb - nb, eb), eg - ng
            yield groups_text(self.a[a], self.b[b], self.group_a[a] - g, self.group_b[b] - g, upto) if na else b""


# --- Spark ------------------------------------------------------------------------------

_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def _pair_type(va: Vocabulary, vb: Vocabulary) -> str:
    return "<u4" if len(va.token) * len(vb.token) <= 1 << 32 else "<i8"


def _linked(path_a: str, path_b: str, with_groups: bool):
    """The tokens' figures of every document, its distinct linked pairs and how often each is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = byte_level(path_a), pieces(path_b)
        kind, upto, row = _pair_type(va, vb), max(len(va.token), len(vb.token)), TaskContext.get().partitionId() << 40
        for batch in small_batches(batches, max_bytes=1 << 20):
            texts, ids_a, ids_b = texts_of(batch), [], []
            for text, a, b in zip(texts, va.encode(texts), vb.encode(texts)):
                whole = (" " + text).encode()
                same = text and b"".join(map(va.token.__getitem__, a)) == whole and b"".join(map(vb.token.__getitem__, b)) == whole
                ids_a.append(np.array(a if same else [], dtype=np.int64))
                ids_b.append(np.array(b if same else [], dtype=np.int64))
            own = Batch(ids_a, ids_b, va.size, vb.size)
            doc, pair, times = own.links(len(vb.token))
            n_links = np.zeros(len(texts), dtype=np.int64)
            np.add.at(n_links, doc, times)
            edges = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
            pair, times = pair.astype(kind), times.astype("<u4")
            packed = [pa.array([x[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()) for x in (pair, times)]
            groups = list(own.texts(upto))
            digests = pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in groups])
            figures = [pa.array(x.astype(np.int64)) for x in (own.n_a, own.n_b, own.n_groups, n_links)]
            columns = [pa.array(np.arange(row, row + len(texts))), batch.column("doc_id"), *figures, digests, *packed]
            names = ["row", "doc_id", *_FIGURES, "groups_sha256", "pairs", "times"]
            if with_groups:
                columns, names = [*columns, pa.array([t.decode() for t in groups])], [*names, "groups"]
            row += len(texts)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _counted(kind: str):
    """(pair, documents that hold it) of a task's documents, a bounded number of pairs at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            pair, n = np.unique(np.concatenate(parts), return_counts=True)
            for lo in range(0, len(pair), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(pair[lo : lo + (1 << 16)].astype(np.int64)), pa.array(n[lo : lo + (1 << 16)])], names=["pair", "n"])

        parts, held = [], 0
        for batch in batches:
            for raw in batch.column("pairs"):
                parts.append(np.frombuffer(raw.as_buffer(), dtype=kind))
                held += len(parts[-1])
                if held >= _FLUSH:
                    yield from told(parts)
                    parts, held = [], 0
        if held:
            yield from told(parts)

    return run


def _looked_up(kind: str, known):
    """(row, n_best, count_sum) over the pairs of the broadcast, and a document's other pairs with their links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = known.value
        for batch in small_batches(batches, column="pairs"):
            n = batch.num_rows
            own = [np.frombuffer(x, dtype=kind) for x in batch.column("pairs").to_pylist()]
            doc = np.repeat(np.arange(n), [len(x) for x in own])
            pair = np.concatenate(own).astype(np.int64)
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), dtype="<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            hit = pairs[at] == pair if len(pairs) else np.zeros(len(pair), dtype=bool)
            n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(n_best, doc[hit], times[hit] * best[at[hit]])
            np.add.at(count_sum, doc[hit], times[hit] * counts[at[hit]])
            ends = np.searchsorted(doc[~hit], np.arange(n + 1)).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(pair[~hit]), pa.array(times[~hit])], ["pair", "times"]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(n_best), pa.array(count_sum), rest], names=["row", "n_best", "count_sum", "rest"])

    return run


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent pairs: whole steps of an eighth of a power of two, ``most`` pairs at most."""
    step = F.floor(F.log2("n") * 8)
    sizes = sorted(((r["step"], r["count"]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    floor, held = None, 0
    for value, size in sizes:
        if held + size > most:
            break
        floor, held = value, held + size
    return counts.where(step >= floor) if floor is not None else counts.limit(0)


def pair_counts(linked: DataFrame, kind: str, width: int) -> DataFrame:
    """(pair, n, best): in how many documents a linked pair stands, and whether no pair of its first id stands in more."""
    dealt = linked.select("pairs").mapInArrow(_counted(kind), "pair long, n long")
    counts = materialize(dealt.groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    first = F.floor(F.col("pair") / width)
    top = counts.groupBy(first.alias("first")).agg(F.max("n").alias("top"))
    return materialize(counts.withColumn("first", first).join(top, "first").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pairs")


def align(docs: DataFrame, path_a: str, path_b: str, broadcast_pairs: int = 1 << 21, with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row (and ``groups``, the text behind
    the digest, on request). ``path_a``: a byte-level BPE file, ``path_b``: a sentencepiece model. A broadcast pair takes 17 bytes."""
    va, vb = byte_level(path_a), pieces(path_b)
    kind = _pair_type(va, vb)
    names = [("row", T.LongType()), ("doc_id", docs.schema["doc_id"].dataType), *((n, T.LongType()) for n in _FIGURES), ("groups_sha256", T.StringType())]
    names += [("pairs", T.BinaryType()), ("times", T.BinaryType())] + [("groups", T.StringType())] * with_groups
    linked = docs.select("doc_id", "text").mapInArrow(_linked(path_a, path_b, with_groups), T.StructType([T.StructField(*n) for n in names]))
    linked = materialize(linked, "linked_pairs")
    counts = pair_counts(linked, kind, len(vb.token))

    some = _frequent(counts, broadcast_pairs).toPandas().sort_values("pair")
    known = docs.sparkSession.sparkContext.broadcast((some["pair"].to_numpy(np.int64), some["n"].to_numpy(np.int64), some["best"].to_numpy(bool)))
    found = linked.select("row", "pairs", "times").mapInArrow(_looked_up(kind, known), "row long, n_best long, count_sum long, rest array<struct<pair: long, times: long>>")
    found = materialize(found, "looked_up")
    other = found.where(F.size("rest") > 0).select("row", F.explode("rest").alias("r")).select("row", "r.pair", "r.times").join(counts, "pair")
    other = other.select("row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    sums = found.select("row", "n_best", "count_sum").unionByName(other).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    columns = ["doc_id", *_FIGURES, "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else [])]
    return linked.drop("pairs", "times").join(sums, "row").select(*columns)
