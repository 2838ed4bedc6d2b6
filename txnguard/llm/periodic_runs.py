"""Runs (maximal repetitions) of words, found from Lyndon arrays under both word orders.

1. A repetition of at least ``min_exponent`` periods holds every one of its
   3-word shingles several times. Words outside such shingles are cut away, again
   and again until nothing changes; no run that counts loses a word by it.
2. Phase one of Baier's suffix sorter groups the suffixes of what is left, once
   under the order of the words and once under the opposite one: groups start as
   the suffixes of one first word and are handled from the greatest down. The
   members of a group hand their prefix to the nearest smaller suffix on their
   left, which moves on to a finer group. The prefix that a suffix ends with is
   its longest Lyndon prefix, so no suffix array is made.
3. By the runs theorem every run has a Lyndon root that is the longest Lyndon
   prefix of a suffix under one of the two orders. The longest common extensions
   of a root and of its next copy, to both sides, give the run. They come from
   ranks of blocks of 1, 2, 4, ... words, so they are exact.

Nothing is shuffled: a text is handled whole in its own task, in Arrow batches
of bounded size (a longer text is a batch of its own).

Cases: a null or empty text has no words and no runs. Texts of any length are
read whole. Runs of one text never depend on another, so repeated rows give equal
results and a null id is passed on. Two runs may start at one word; they are
told apart by their periods. Other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txnguard.llm.common import small_batches, texts_of


def lyndon_array(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon prefix of each suffix. Code 0 is a sentinel: the list starts and ends with
    one, no factor spans it and its own entries are 0."""
    first: dict[int, list[int]] = {}
    for i, c in enumerate(codes):
        first.setdefault(c, []).append(i)
    members = [first[c] for c in sorted(first)]  # of a group; those that moved on since are skipped
    context = [1] * len(members)  # length of the prefix that a group's suffixes share
    below, above = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    group = [0] * len(codes)
    for g, own in enumerate(members):
        for i in own:
            group[i] = g
    left = list(range(len(codes)))  # towards the nearest position to the left whose group is still to come
    out = [0] * len(codes)
    now = len(members) - 1
    while now > 0:  # group 0 are the sentinels
        size, own = context[now], [i for i in members[now] if group[i] == now]
        for i in own:
            left[i] = i - 1
            out[i] = size
        times: dict[int, int] = {}
        for i in own:
            j = i - 1
            while left[j] != j:
                left[j] = j = left[left[j]]
            left[i] = j
            if group[j]:
                times[j] = times.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, n in times.items():
            moved.setdefault((n, group[j]), []).append(j)
        for n, old in sorted(moved, reverse=True):  # the more copies follow, the greater the suffix
            fresh, up = len(members), above[old]
            members.append(moved[n, old])
            context.append(context[old] + n * size)
            below.append(old)
            above.append(up)
            above[old] = fresh
            if up >= 0:
                below[up] = fresh
            for j in members[fresh]:
                group[j] = fresh
        now = below[now]
    return out


class Extensions:
    """Longest common extensions of places in a sequence, by ranks of its blocks of 1, 2, 4, ... words."""

    def __init__(self, codes: np.ndarray):
        ranks = np.unique(codes, return_inverse=True)[1].astype(np.int64)
        self.ranks, self.n, size = [ranks], len(ranks), 1
        while 2 * size <= self.n:
            pairs = ranks[: self.n - 2 * size + 1] * (self.n + 1) + ranks[size : self.n - size + 1]
            distinct, ranks = np.unique(pairs, return_inverse=True)
            if len(distinct) == len(ranks):
                break  # no block of this size occurs twice
            ranks = ranks.astype(np.int64)
            self.ranks.append(ranks)
            size *= 2

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from ``a`` and from ``b`` > ``a`` on."""
        got = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            r = self.ranks[k]
            at = np.minimum(b + got, len(r) - 1)
            got += ((b + got < len(r)) & (r[np.minimum(a + got, len(r) - 1)] == r[at])).astype(np.int64) << k
        return got

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree before ``a`` and before ``b`` > ``a``."""
        got = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            r, size = self.ranks[k], 1 << k
            at, other = a - got - size, b - got - size
            got += ((at >= 0) & (r[np.maximum(at, 0)] == r[np.maximum(other, 0)])).astype(np.int64) << k
        return got


def _repetitive(codes: np.ndarray, owner: np.ndarray, need: int, least: int) -> np.ndarray:
    """Places that may lie in a run, by place: words covered by a shingle that occurs ``need`` times in its stretch."""
    at = np.arange(len(codes))
    part = owner  # the stretch of a word; it only gets shorter
    while len(at) >= 3:
        c = codes[at]
        whole = (at[2:] == at[:-2] + 2) & (part[2:] == part[:-2])
        h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15) + c[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + c[2:]
        h = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + part[2:].astype(np.uint64)) * np.uint64(0x94D049BB133111EB)
        h = h[whole] >> np.uint64(64 - max(10, int(4 * len(at)).bit_length()))  # different shingles that share a slot cut less, never more
        often = np.bincount(h.astype(np.int64))[h.astype(np.int64)] >= need
        covered = np.zeros(len(at), dtype=bool)
        start = np.flatnonzero(whole)[often]
        for j in range(3):
            covered[start + j] = True
        # stretches of neighbouring covered words of one part; those too short for a run go
        place, own = at[covered], part[covered]
        if not len(place):
            return place
        cut = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(own) != 0)])
        stretch = np.cumsum(cut) - 1
        long_enough = np.bincount(stretch)[stretch] >= least
        place, own = place[long_enough], stretch[long_enough]
        if len(place) == len(at):
            return place
        at, part = place, own
    return at[:0]


def find_runs(words: list[list[bytes]], min_length: int = 6, min_exponent: int = 4) -> list[np.ndarray]:
    """The runs (start, length, period) of each sequence, by start, then period: stretches that keep a smallest period q,
    that no neighbouring word extends, of at least ``min_length`` words and ``min_exponent`` (2 or more) periods."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    none, starts = np.zeros((0, 3), dtype=np.int64), np.cumsum(sizes) - sizes
    known: dict[bytes, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known) + 1) for own in words for w in own), dtype=np.int64, count=int(sizes.sum()))
    owner = np.repeat(np.arange(len(words)), sizes)
    least = max(min_length, min_exponent)
    need = min(min_exponent - 1, least - 2)  # a run of period 1 has length - 2 shingles, of period q each at least exponent - 2/q times
    at = _repetitive(codes.view(np.uint64), owner, need, least) if need >= 2 else np.arange(len(codes))
    if not len(at):
        return [none] * len(words)
    # what is left as one sequence, a sentinel (place -1) around every stretch
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(owner[at]) != 0)) + 1
    place = np.concatenate([[-1], np.insert(at, cut, -1), [-1]])
    own = np.where(place >= 0, codes[place], 0)
    inner = own > 0
    up = np.zeros(len(own), dtype=np.int64)
    up[inner] = np.unique(own[inner], return_inverse=True)[1] + 1
    down = np.where(inner, up.max() + 1 - up, 0)
    apart = np.where(inner, own, -np.arange(1, len(own) + 1))  # sentinels differ from all, so nothing extends over them
    same = Extensions(apart)
    found = []
    for order in (up, down):
        root = np.array(lyndon_array(order.tolist()), dtype=np.int64)
        i = np.flatnonzero((root > 0) & (np.arange(len(root)) + root < len(root)))
        i = i[apart[i] == apart[i + root[i]]]
        q = root[i]
        ahead = same.forward(i, i + q)
        ok = ahead >= (min_exponent - 2) * q  # true of a run's first root that is not at its start
        i, q, ahead = i[ok], q[ok], ahead[ok]
        back = same.backward(i, i + q)
        length = back + q + ahead
        ok = length >= np.maximum(min_length, min_exponent * q)
        found.append(np.column_stack([(i - back)[ok], length[ok], q[ok]]))
    runs = np.unique(np.concatenate(found), axis=0)
    at = place[runs[:, 0]]
    doc = owner[at]
    runs[:, 0] = at - starts[doc]
    order = np.lexsort((runs[:, 2], runs[:, 0], doc))
    edges = np.searchsorted(doc[order], np.arange(len(words) + 1))
    return [runs[order[a:b]] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def repeats_of(runs: np.ndarray, n: int) -> np.ndarray:
    """For each of n words, whether a run holds it after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge)[:n] > 0


def detect(docs: DataFrame, min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period; by start, then period) and ``collapsed``, the words that no run repeats, of every row."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["start", "length", "period"]
        for batch in small_batches(batches):
            words = [t.encode().split() for t in texts_of(batch)]
            found = find_runs(words, min_length, min_exponent)
            kept = []
            for own, runs in zip(words, found):
                if len(runs):
                    gone = repeats_of(runs, len(own)).tolist()
                    own = [w for w, g in zip(own, gone) if not g]
                kept.append(b" ".join(own))
            flat = np.concatenate(found)
            ends = np.concatenate([[0], np.cumsum([len(r) for r in found])])
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields))
            columns = [batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()), runs, pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(search, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
