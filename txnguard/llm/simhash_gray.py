"""SimHash near-duplicates by a Gray-order hierarchical index.

``fingerprints`` gives every whole text its 64-bit SimHash over word shingles.
Links are pairs of distinct fingerprints at ``max_bits`` or fewer differing bits:

* Routing: two fingerprints at distance 2 agree on one of three blocks of their
  bits, and on one of three parts of the remaining bits, and so on. A bucket is
  all fingerprints that agree on such a choice; each fingerprint goes to nine
  buckets. A bucket with more than ``bucket_rows`` fingerprints is dealt again
  by the next choice of parts, which at the last level leaves 512 values at
  most: no bucket is unbounded, and no pair is lost.
* Index: within a bucket the fingerprints are sorted by Gray rank. Groups of
  eight neighbours become a node that holds the bits they all share; a parent
  takes over the bits that its children share, so a child's node has only what
  is left to compare. A search goes down from the root for all fingerprints at
  once, adds up the differences on each node's own bits and drops a group as
  soon as the sum exceeds the limit.

A pair is reported in one bucket only, that of the first choices on which it
agrees. Components are computed on distinct fingerprints (``components``).

Cases: a null text, and one without a word, has fingerprint zero and is linked
like any other. A text of fewer words than a shingle is one shingle. Equal
fingerprints share a component. A component's id is its smallest document id;
null ids are ignored there, so a component of null ids alone has a null id.
Repeated rows are returned as often as they occur; other columns are ignored.
Texts of any length are read whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import materialize, small_batches, texts_of
from txnguard.llm.components import components

FANOUT = 8
BUCKET_ROWS = 2048
FIRST_LEVEL, LAST_LEVEL = 2, 5


# --- fingerprints ---------------------------------------------------------------------


def fingerprint(text: str, shingle: int = 3, part: int = 1 << 15) -> int:
    """Bit i is set if it is set in over half of the shingles' XXH64 hashes."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[shingle - 1 :].tolist() or [len(joined)]
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for lo in range(0, len(last), part):
        h = np.array([digest(joined[a:b], seed=42) for a, b in zip(starts[lo:], last[lo : lo + part])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(last), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, t, fp) of every row: a hash of the text, and the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts_of(batch)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), pa.array(fps, pa.int64())], names=["doc_id", "t", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(run, f"doc_id {kind}, t long, fp long")


# --- routing --------------------------------------------------------------------------


def choice_masks(level: int) -> list[tuple[int, int]]:
    """(choice, mask) of the bits that a bucket agrees on; a choice's children are 3 * choice + 0, 1, 2."""
    out = [(0, [], list(range(64)))]
    for _ in range(level):
        out = [
            (3 * choice + i, kept + part.tolist(), [b for j, other in enumerate(np.array_split(rest, 3)) if j != i for b in other.tolist()])
            for choice, kept, rest in out
            for i, part in enumerate(np.array_split(rest, 3))
        ]
    return [(choice, sum(1 << b for b in kept)) for choice, kept, _ in out]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _routes(fps: DataFrame, level: int) -> DataFrame:
    """A row for each bucket of each fingerprint; ``parent`` and ``parent_key`` name the bucket one level up."""
    up = dict(choice_masks(level - 1))
    entries = [
        F.struct(F.lit(c).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"), F.lit(c // 3).alias("parent"), F.col("fp").bitwiseAND(F.lit(_signed(up[c // 3]))).alias("parent_key"))
        for c, m in choice_masks(level)
    ]
    return fps.select("fp", F.explode(F.array(*entries)).alias("r")).select("fp", "r.*")


def _first_agreement(diff: np.ndarray, level: int) -> np.ndarray:
    """The bucket choice in which a pair with these differing bits is reported."""
    choice = np.full(len(diff), -1, dtype=np.int64)
    for c, m in sorted(choice_masks(level), reverse=True):
        choice[(diff & np.uint64(m)) == 0] = c
    return choice


# --- the index ------------------------------------------------------------------------


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)


def _expand(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place within the row) for rows of these sizes."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(_starts(sizes), sizes)


def search(codes: np.ndarray, sizes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i < j) of all pairs within ``max_bits`` inside each bucket.

    ``codes`` holds the buckets one after the other, each sorted by Gray rank.
    """
    levels = []  # from the leaves up: shared bits, their values, children per node, first child
    ands, ors, per_bucket = codes, codes, sizes
    while True:
        nodes = -(-per_bucket // FANOUT)
        bucket, place = _expand(nodes)
        first = _starts(per_bucket)[bucket] + place * FANOUT
        children = np.minimum(FANOUT, per_bucket[bucket] - place * FANOUT)
        ands, ors = np.bitwise_and.reduceat(ands, first), np.bitwise_or.reduceat(ors, first)
        levels.append((~(ands ^ ors), ands, children, first))
        per_bucket = nodes
        if (nodes <= 1).all():
            break
    query = np.arange(len(codes))
    node, _ = _expand(sizes)  # every code starts at its own bucket's root
    taken, sums = np.zeros(len(codes), dtype=np.uint64), np.zeros(len(codes), dtype=np.uint8)
    for shared, value, children, first in reversed(levels):
        sums = sums + np.bitwise_count((codes[query] ^ value[node]) & shared[node] & ~taken)
        near = sums <= max_bits
        query, node, sums = query[near], node[near], sums[near]
        row, place = _expand(children[node])
        taken, query, node, sums = shared[node][row], query[row], first[node][row] + place, sums[row]
    near = (node > query) & (sums + np.bitwise_count((codes[query] ^ codes[node]) & ~taken) <= max_bits)
    return query[near], node[near]


def _search_buckets(level: int, max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, choices = batch.column("fps"), batch.column("choice").to_numpy(zero_copy_only=False).astype(np.int64)
            all_sizes = np.diff(lists.offsets.to_numpy())
            all_codes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            lo, at = 0, _starts(all_sizes)
            cost = np.cumsum(all_sizes.astype(np.int64) ** 2)
            while lo < len(all_sizes):  # as many buckets as the search's arrays have room for
                hi = max(lo + 1, int(np.searchsorted(cost, (cost[lo - 1] if lo else 0) + (1 << 22), side="right")))
                sizes = all_sizes[lo:hi]
                codes = all_codes[at[lo] : at[lo] + sizes.sum()]
                bucket, _ = _expand(sizes)
                codes = codes[np.lexsort((gray_rank(codes), bucket))]
                i, j = search(codes, sizes, max_bits)
                own = _first_agreement(codes[i] ^ codes[j], level) == choices[lo:hi][bucket[i]]
                yield pa.RecordBatch.from_arrays([pa.array(codes[k[own]].view(np.int64), pa.int64()) for k in (i, j)], names=["a", "b"])
                lo = hi

    return run


def links(fps: DataFrame, max_bits: int = 2, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Every pair (a, b) of the distinct fingerprints ``fps`` (column fp) within ``max_bits``, once."""
    if not 0 <= max_bits <= 2:
        raise ValueError("three blocks find pairs at 0 to 2 differing bits")
    out, hot = None, None
    for level in range(FIRST_LEVEL, LAST_LEVEL + 1):
        routed = _routes(fps, level)
        if hot is not None:  # only what was too large one level up
            routed = routed.join(hot.select(F.col("choice").alias("parent"), F.col("key").alias("parent_key")), ["parent", "parent_key"], "left_semi")
        routed = routed.select("choice", "key", "fp")
        hot = None
        if level < LAST_LEVEL:
            hot = materialize(routed.groupBy("choice", "key").count().where(F.col("count") > bucket_rows), "hot_buckets")
            hot = None if hot.isEmpty() else hot
        cold = routed if hot is None else routed.join(hot, ["choice", "key"], "left_anti")
        buckets = cold.groupBy("choice", "key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        found = materialize(buckets.select("choice", "fps").mapInArrow(_search_buckets(level, max_bits), "a long, b long"), "links")
        out = found if out is None else out.unionByName(found)
        if hot is None:
            break
    return out


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, t, fp, component, component_id) of every row; ``component`` is the component's smallest fingerprint."""
    marked = materialize(fingerprints(docs, shingle), "fingerprints")
    lowest = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    found = components(links(lowest.select("fp"), max_bits, bucket_rows))
    named = lowest.join(found.withColumnRenamed("vertex", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = materialize(named, "named")
    ids = materialize(named.groupBy("component").agg(F.min("least").alias("component_id")), "component_ids")
    classes = materialize(named.select("fp", "component").join(ids, "component").select("fp", "component", "component_id"), "classes")
    return marked.join(classes, "fp").select("doc_id", "t", "fp", "component", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row, with its own columns, of each component: that of the smallest id, then of the smallest text hash; null ids come last."""
    marks = materialize(near_duplicates(docs, **options), "marks")
    first = F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "t")
    chosen = marks.groupBy("component").agg(F.min(first).alias("c")).select("c.doc_id", "c.t").alias("c")
    times = marks.groupBy("doc_id", "t").count().alias("n")
    chosen = materialize(chosen.join(times, F.expr("c.doc_id <=> n.doc_id and c.t = n.t")).select("c.doc_id", "c.t", "count"), "chosen")

    def rows(some: DataFrame) -> DataFrame:
        return docs.alias("d").join(some.alias("c"), F.expr("d.doc_id <=> c.doc_id and xxhash64(d.text) = c.t"), "left_semi")

    return rows(chosen.where("count = 1")).unionByName(rows(chosen.where("count > 1")).dropDuplicates(["doc_id", "text"]))
