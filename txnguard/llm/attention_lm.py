"""Language-model scores by a causal self-attention model on subword ids, in numpy.

Statistics: one reading of the corpus writes every document's subword ids and counts
words and ids over all training documents; Arrow splits the texts, so each batch looks
up a word once. They give the base model (add-one unigrams) and the frequencies that order the model's vocabulary. The words with at least ``floor`` occurrences, ``broadcast_words`` at
most, are broadcast; rarer words join their counts in a shuffle.

Model: one layer of causal attention with learned positions and a skip path. The
frequent ids sit in equal clusters, split again and again along the principal
direction of the ids they stand next to; an id's probability is its cluster's
times its own within the cluster, both softmaxes of the same state. All other ids
share one more cluster in which they have corpus-unigram probabilities.

Training: the neighbours that order the clusters and the starting frequencies are
counted over all training documents. The driver starts the weights by Adam on a
bounded sample (``max_docs`` documents, the lowest hashes, ``max_windows`` windows
of each). From there Spark learns from every window of every training document:
in each of ``ROUNDS`` rounds, which share the documents out by hash, every task
runs Adam over its own windows and the weights are averaged, by windows learned.

Scoring: a document's ids and an end id are cut into windows that overlap by
``CONTEXT``; each window scores only what no earlier one did, so every id counts
once, with 8 to 31 ids before it. Windows of many documents run as one batch.

Cases: a null text is an empty one, which has the end alone. Repeated rows are
counted and scored as often as they occur. A null id is in no held-out fold.
Without training documents every word is unknown and the model is uniform over
clusters. Texts of any length are read whole, window by window. Words of equal counts
are ordered by id. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import hash_cut, materialize, small_batches
from txnguard.llm.linear import Adam
from txnguard.llm.subwords import encoder

WINDOW, CONTEXT = 32, 8
STRIDE = WINDOW - CONTEXT
WIDTH = 16
CLUSTERS, CLUSTER = 64, 36
KINDS = 128  # the most frequent ids, next to which all others are counted
ROUNDS = 4
LN10, LOG2E = float(np.log(10.0)), float(np.log2(np.e))
_SEEN = (np.arange(WINDOW)[None, :] <= np.arange(CONTEXT, WINDOW)[:, None]).astype(np.float32)
_MASK = np.where(_SEEN > 0, np.float32(0), np.float32(-1e9))


@dataclass
class AttentionModel:
    """``slot``: of each id its place in cluster order; ids beyond the frequent ones share the last slot."""

    slot: np.ndarray
    rare: np.ndarray  # natural log of each id's share of the rare cluster
    params: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def outside(self) -> int:
        return CLUSTERS * CLUSTER


# --- windows --------------------------------------------------------------------------


def windows_of(sequences: list[np.ndarray], outside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (n, WINDOW), targets (n, STRIDE) and each window's sequence; -1 targets are padding.

    ``sequences`` hold slots, the end included; ``outside + 1`` stands before the first.
    """
    start = outside + 1
    counts = np.array([len(s) for s in sequences], dtype=np.int64)
    per = -(-counts // STRIDE)
    base = np.cumsum(per * STRIDE) - per * STRIDE
    flat = np.full(int((per * STRIDE).sum()), -1, dtype=np.int32)
    at = np.repeat(base, counts) + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    flat[at] = np.concatenate(sequences) if len(sequences) else []
    targets = flat.reshape(-1, STRIDE)
    owner = np.repeat(np.arange(len(sequences)), per)
    # a window's inputs: the STRIDE places one to the left of its targets, and CONTEXT more
    shifted = np.empty_like(targets)
    shifted[:, 1:] = targets[:, :-1]
    first = np.ones(len(targets), dtype=bool)
    first[1:] = owner[1:] != owner[:-1]
    shifted[1:, 0] = targets[:-1, -1]
    shifted[first, 0] = start
    before = np.full((len(targets), CONTEXT), start, dtype=np.int32)
    before[1:] = shifted[:-1, STRIDE - CONTEXT :]
    before[first] = start
    inputs = np.concatenate([before, shifted], axis=1)
    inputs[inputs < 0] = start
    return inputs, targets, owner


# --- forward and backward -------------------------------------------------------------


@dataclass
class _Laid:
    """The parameters laid out for a batch: projections of every id and place by all four matrices at once, a column
    of ones behind the values, and the output layers with their biases as further rows. Logits are to base 2.

    ``mixing``: the values are those after ``mix``, which is all that scoring asks for. ``flat``: the output logits
    can't overflow an exponential: the state is at most 1 in size, so a bound on them follows from the parameters.
    ``steep``: sums of so large terms that their rounding in single precision would show in the gradients.
    """

    table: np.ndarray
    places: np.ndarray
    top: np.ndarray
    low: np.ndarray
    flat: bool
    steep: bool

    @staticmethod
    def of(p: dict, mixing: bool = False) -> _Laid:
        kind, w = p["embed"].dtype, WIDTH
        scale = kind.type(LOG2E)
        joint = np.hstack([p["k"], p["v"] @ p["mix"] if mixing else p["v"], np.zeros((w, 1), kind), p["q"] * scale, p["skip"]])
        places = p["place"] @ joint
        places[:, 2 * w] = 1
        places[:, _SKIP] += p["bias"]
        top = np.vstack([p["top"], p["top_bias"]])
        low = np.concatenate([p["low"], p["low_bias"][:, None]], axis=1)
        flat = max(np.abs(top).sum(axis=0).max(), np.abs(low).sum(axis=1).max()) < 70
        table = p["embed"] @ joint
        return _Laid(table, places, top * scale, low * scale, bool(flat), bool(max(np.abs(table).max(), np.abs(places).max()) > 512))


_K, _V, _V_ONE, _Q, _SKIP = (slice(a * WIDTH + c, b * WIDTH + d) for a, c, b, d in ((0, 0, 1, 0), (1, 0, 2, 0), (1, 0, 2, 1), (2, 1, 3, 1), (3, 1, 4, 1)))
_CLUSTER_OF = np.append(np.arange(CLUSTERS * CLUSTER + 1) // CLUSTER, CLUSTERS + 1).astype(np.uint8)  # of each slot; the last is that of -1


def _level(y: np.ndarray, flat: bool = False, mask: np.ndarray | None = None) -> np.ndarray:
    """Rows of logits to base 2, lowered in place by their largest value where a power of some could overflow or vanish."""
    if not flat and y.size and max(y.max(), -y.min()) > 100:
        if mask is not None:
            y += mask
        y -= y.max(axis=-1, keepdims=True)
        np.maximum(y, -120, out=y)
    return y


def _powers(y: np.ndarray) -> np.ndarray:
    """2 to the values of a ``_level`` array, in place.

    Single precision: numpy has no vector code for exponentials on every CPU, so a polynomial gives the fraction's square
    root, within 1e-7 and exact at 0, and the whole part goes to the exponent's bits.
    """
    if y.dtype != np.float32:
        np.exp2(y, out=y)
    else:
        every = y.reshape(-1)
        wholes, roots, shifts = np.empty(_CACHED, np.float32), np.empty(_CACHED, np.float32), np.empty(_CACHED, np.int32)
        for lo in range(0, len(every), _CACHED):
            part = every[lo : lo + _CACHED]
            whole, root, shift = wholes[: len(part)], roots[: len(part)], shifts[: len(part)]
            np.rint(part, out=whole)
            part -= whole
            np.multiply(part, _ROOT[0], out=root)
            for c in _ROOT[1:-1]:
                root += c
                root *= part
            root += _ROOT[-1]
            np.square(root, out=part)
            np.copyto(shift, whole, casting="unsafe")
            shift <<= 23
            raised = part.view(np.int32)
            raised += shift
    return y


_CACHED = 1 << 15  # logits at a time, whose steps stay in a core's cache
_ROOT = [np.float32(c) for c in (0.000600624647, 0.00695082893, 0.0600568452, 0.34657282, 1)]  # of 2 ** (x / 2), x from -0.5 to 0.5


def _attention(laid: _Laid, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Projections of the inputs, attention times its rows' sums, and the values mixed by it with these sums behind."""
    a = laid.table.take(inputs, axis=0, mode="clip")
    a += laid.places
    e = _powers(_level(a[:, CONTEXT:, _Q] @ a[..., _K].transpose(0, 2, 1), mask=_MASK))
    e *= _SEEN
    return a, e, (e @ a[..., _V_ONE]).reshape(-1, WIDTH + 1)


def _state(z: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The state of every target from what attention adds, with a column of ones that carries the biases."""
    z += a[:, CONTEXT:, _SKIP].reshape(-1, WIDTH)
    h = np.ones((len(z), WIDTH + 1), dtype=z.dtype)
    np.tanh(z, out=h[:, :WIDTH])
    return h


_ONES = np.ones(CLUSTERS + 1, dtype=np.float32)


def log_probs(model: AttentionModel, inputs: np.ndarray, targets: np.ndarray, batch: int = 256) -> np.ndarray:
    """Natural-log probability of each target slot; 0 where there is none."""
    laid = _Laid.of(model.params, mixing=True)
    out = np.zeros(targets.shape, dtype=np.float32)
    for lo in range(0, len(inputs), batch):
        order, y, cluster, edges = _by_cluster(targets[lo : lo + batch])
        a, _, mixed = _attention(laid, inputs[lo : lo + batch])
        h = _state(mixed[:, :WIDTH] / mixed[:, WIDTH:], a)[order]
        at, inside = np.arange(len(y)), edges[CLUSTERS]
        z = h @ laid.top
        got = _level(z, laid.flat)[at, cluster]
        got -= np.log2(_powers(z) @ _ONES)
        z = _inner(h, laid.low, edges)
        got[:inside] += _level(z, laid.flat)[at[:inside], y[:inside] - cluster[:inside] * CLUSTER]
        got[:inside] -= np.log2(_powers(z) @ _ONES[:CLUSTER])
        out[lo : lo + batch].ravel()[order] = got / LOG2E
    return out


def _by_cluster(targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Places of the targets in order of their clusters, so that each one's rows are one slice; their slots, clusters and the slices' edges."""
    y = targets.ravel()
    cluster = _CLUSTER_OF[y]
    order = np.argsort(cluster, kind="stable")
    cluster = cluster[order]
    edges = np.searchsorted(cluster, np.arange(CLUSTERS + 2, dtype=np.uint8)).tolist()
    order = order[: edges[-1]]
    return order, y[order], cluster[: edges[-1]].astype(np.int32), edges


def _inner(h: np.ndarray, low: np.ndarray, edges: list[int]) -> np.ndarray:
    """Logits within their clusters of states in order of these; the rare cluster, which comes last, has none."""
    z = np.empty((edges[CLUSTERS], CLUSTER), dtype=h.dtype)
    for c in range(CLUSTERS):
        if edges[c + 1] > edges[c]:
            np.matmul(h[edges[c] : edges[c + 1]], low[c], out=z[edges[c] : edges[c + 1]])
    return z


def _gradients(p: dict, inputs: np.ndarray, targets: np.ndarray, laid: _Laid | None = None, with_loss: bool = True) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of the slots (0 unless asked for), and its gradients."""
    n, w, kind = len(inputs), WIDTH, p["embed"].dtype
    flat = lambda t: t.reshape(-1, t.shape[-1])
    laid = laid or _Laid.of(p)
    if laid.steep and kind == np.float32:
        loss, g = _gradients({name: v.astype(np.float64) for name, v in p.items()}, inputs, targets, with_loss=with_loss)
        return loss, {name: v.astype(kind) for name, v in g.items()}
    a, e, mixed = _attention(laid, inputs)
    inverse = 1 / mixed[:, w:]
    mixed = mixed[:, :w] * inverse
    h = _state(mixed @ p["mix"], a)

    g, loss = {}, 0.0
    order, y, cluster, edges = _by_cluster(targets)
    at, inside, real = np.arange(len(y)), edges[CLUSTERS], max(1, len(y))
    own = h[order]
    z = _powers(_level(own @ laid.top, laid.flat))
    z *= (1 / (real * (z @ np.ones(z.shape[1], kind))))[:, None]
    if with_loss:
        loss -= np.log(z[at, cluster] * real + 1e-20).sum()
    z[at, cluster] -= kind.type(1 / real)
    top = own.T @ z
    g["top"], g["top_bias"] = top[:w], top[w]
    dh = z @ p["top"].T
    z = _powers(_level(_inner(own, laid.low, edges), laid.flat))
    z *= (1 / (real * (z @ np.ones(CLUSTER, kind))))[:, None]
    at, member = at[:inside], y[:inside] - cluster[:inside] * CLUSTER
    if with_loss:
        loss -= np.log(z[at, member] * real + 1e-20).sum()
    z[at, member] -= kind.type(1 / real)
    inner, back = np.zeros_like(laid.low), np.empty((inside, w), dtype=kind)
    for c in range(CLUSTERS):
        rows = slice(edges[c], edges[c + 1])
        if rows.stop > rows.start:
            np.matmul(own[rows].T, z[rows], out=inner[c])
            np.matmul(z[rows], p["low"][c].T, out=back[rows])
    g["low"], g["low_bias"] = inner[:, :w], inner[:, w]
    dh[:inside] += back

    own = own[:, :w]
    dh *= 1 - own * own
    dz = np.zeros((len(h), w), dtype=kind)
    dz[order] = dh
    g["bias"], g["mix"] = np.ones(len(dz), kind) @ dz, mixed.T @ dz
    dmixed = dz @ p["mix"].T
    dmixed *= inverse
    ds = dmixed.reshape(n, -1, w) @ a[..., _V].transpose(0, 2, 1)
    ds *= e
    ds -= e * ((flat(ds) @ np.ones(WINDOW, kind)) * inverse[:, 0]).reshape(n, -1, 1)
    d = np.empty((n, WINDOW, 4 * w), dtype=kind)
    np.matmul(ds.transpose(0, 2, 1), a[:, CONTEXT:, _Q], out=d[..., :w])
    np.matmul(e.transpose(0, 2, 1), dmixed.reshape(n, -1, w), out=d[..., w : 2 * w])
    np.matmul(ds, a[..., _K], out=d[:, CONTEXT:, 2 * w : 3 * w])
    d[:, CONTEXT:, 3 * w :] = dz.reshape(n, -1, w)
    d[:, :CONTEXT, 2 * w :] = 0
    x = p["embed"].take(inputs, axis=0, mode="clip")
    x += p["place"]
    g["k"], g["v"], g["q"], g["skip"] = np.hsplit(flat(x).T @ flat(d), 4)
    unscaled = kind.type(1 / LOG2E)  # the queries of ``laid`` are to base 2
    g["k"] *= unscaled
    dx = flat(d) @ np.hstack([p["k"] * unscaled, p["v"], p["q"], p["skip"]]).T
    g["place"] = (np.ones(n, kind) @ dx.reshape(n, -1)).reshape(WINDOW, w)
    size = len(p["embed"])
    cells = _CELLS[:size].take(inputs.ravel(), axis=0, mode="clip")
    g["embed"] = np.bincount(cells.ravel(), weights=dx.ravel(), minlength=size * w).reshape(size, w).astype(kind)
    return float(loss / real), g


_CELLS = np.arange((CLUSTERS * CLUSTER + 2) * WIDTH).reshape(-1, WIDTH)


def neighbours(ranks: list[np.ndarray], size: int) -> np.ndarray:
    """How often each of ``size`` ids, given by rank, stands before and after each of the first KINDS; further ranks are none."""
    flat = np.concatenate([x for r in ranks for x in (r.astype(np.int64), [size])] or [np.zeros(0, np.int64)])
    near = np.zeros((2, size * KINDS))
    for side, (a, b) in enumerate(((flat[1:], flat[:-1]), (flat[:-1], flat[1:]))):
        ok = (a < size) & (b < min(size, KINDS))
        near[side] = np.bincount(a[ok] * KINDS + b[ok], minlength=size * KINDS)
    return np.hstack(near.reshape(2, size, KINDS))


def clusters_of(near: np.ndarray, ids: np.ndarray, seed: int = 5) -> np.ndarray:
    """``ids`` (CLUSTERS * CLUSTER of them) in cluster order: halves along the principal direction of their ``neighbours``."""
    near = np.sqrt(near / np.maximum(near.sum(axis=1, keepdims=True), 1)).astype(np.float32)
    rng = np.random.default_rng(seed)
    groups = [np.arange(len(ids))]
    while len(groups) < CLUSTERS:
        after = []
        for own in groups:
            x = near[own] - near[own].mean(axis=0)
            d = rng.normal(size=x.shape[1]).astype(np.float32)
            for _ in range(12):
                d = x.T @ (x @ d)
                d /= np.linalg.norm(d) + 1e-12
            order = own[np.argsort(x @ d, kind="stable")]
            after += [order[: len(order) // 2], order[len(order) // 2 :]]
        groups = after
    return ids[np.concatenate(groups)]


def frequent_ids(id_counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids that have a place in the clusters, the most frequent first, and every id's rank among them."""
    counts = id_counts.astype(np.float64)
    counts[end_id] = counts.max(initial=0) + 1  # the end is always one of them
    frequent = np.argsort(-counts, kind="stable")[: CLUSTERS * CLUSTER]
    rank = np.full(len(counts), CLUSTERS * CLUSTER, dtype=np.int32)
    rank[frequent] = np.arange(len(frequent))
    return frequent, rank


def train(sequences: list[np.ndarray], id_counts: np.ndarray, end_id: int, max_windows: int = 64, epochs: int = 2, rate: float = 0.02, batch: int = 96, seed: int = 3, near: np.ndarray | None = None) -> AttentionModel:
    """Fit the model to id sequences; ``id_counts``: corpus counts of all ids; ``near``: the corpus's ``neighbours``, default those of the sequences."""
    counts = id_counts.astype(np.float64)
    frequent, rank = frequent_ids(id_counts, end_id)
    placed = clusters_of(neighbours([rank[s] for s in sequences], len(frequent)) if near is None else near, frequent)
    slot = np.full(len(counts), CLUSTERS * CLUSTER, dtype=np.int32)
    slot[placed] = np.arange(len(placed))
    rare = np.where(slot == CLUSTERS * CLUSTER, counts + 1, 0.0)
    rng = np.random.default_rng(seed)
    f = lambda *shape: rng.normal(scale=shape[0] ** -0.5, size=shape).astype(np.float32)
    zeros = lambda *shape: np.zeros(shape, dtype=np.float32)
    w, outs = WIDTH, CLUSTERS + 1
    p = {
        "embed": rng.normal(scale=0.5, size=(CLUSTERS * CLUSTER + 2, w)).astype(np.float32), "place": zeros(WINDOW, w), "q": f(w, w), "k": f(w, w), "v": f(w, w),
        "skip": f(w, w), "mix": f(w, w), "bias": zeros(w), "top": f(w, outs), "top_bias": zeros(outs), "low": np.zeros((CLUSTERS, w, CLUSTER), np.float32), "low_bias": zeros(CLUSTERS, CLUSTER),
    }
    model = AttentionModel(slot, np.log(np.maximum(rare, 1e-300) / max(rare.sum(), 1.0)), p)
    # start from the frequencies: cluster and member biases are their logarithms
    seen = np.append(np.pad(counts[placed], (0, CLUSTERS * CLUSTER - len(placed))), counts[slot == CLUSTERS * CLUSTER].sum()) + 0.05
    p["low_bias"][:] = np.log(seen[:-1].reshape(CLUSTERS, CLUSTER) / seen[:-1].reshape(CLUSTERS, CLUSTER).sum(axis=1, keepdims=True))
    p["top_bias"][:] = np.log(np.append(seen[:-1].reshape(CLUSTERS, CLUSTER).sum(axis=1), seen[-1]) / seen.sum())
    if not sequences:
        return model
    inputs, targets, owner = windows_of([slot[s] for s in sequences], model.outside)
    keep = np.concatenate([rng.permutation(np.flatnonzero(owner == i))[:max_windows] for i in np.unique(owner)])
    inputs, targets = inputs[keep], targets[keep]
    names = list(p)
    adam = Adam([p[n] for n in names], rate)
    steps = epochs * -(-len(inputs) // batch)
    for epoch in range(epochs):
        order = rng.permutation(len(inputs))
        for lo in range(0, len(inputs), batch):
            _, g = _gradients(p, inputs[order[lo : lo + batch]], targets[order[lo : lo + batch]], with_loss=False)
            adam.rate = rate * max(0.05, 1 - adam.t / steps)
            adam.step([g[n] for n in names])
    return model


def score_ids(model: AttentionModel, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each id sequence (the end included)."""
    slots = [model.slot[s] for s in sequences]
    inputs, targets, owner = windows_of(slots, model.outside)
    total = np.bincount(owner, weights=log_probs(model, inputs, targets).sum(axis=1, dtype=np.float64), minlength=len(sequences))
    for i, (s, own) in enumerate(zip(sequences, slots)):
        odd = s[own == model.outside]
        if len(odd):
            total[i] += model.rare[odd].sum()
    return total / LN10


# --- the corpus -----------------------------------------------------------------------


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and all of them; what lies between ASCII white space is a word, as for ``bytes.split``."""
    trimmed = pc.ascii_trim_whitespace(texts)
    split = pc.ascii_split_whitespace(pc.if_else(pc.equal(trimmed, ""), None, trimmed))
    return pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64), split.flatten()


def keep_memory(size: int = 8 << 20) -> None:
    """Freeing one large block makes malloc keep up to twice its size instead of giving pages back and faulting them in again for each batch."""
    np.empty(size, dtype=np.uint8)


class _Words(dict):
    """Numbers of words, in the order in which they are met, 0 being left to the end; ``new``: the words that were met since it was emptied."""

    def __init__(self, words: list[bytes] = ()) -> None:
        super().__init__(zip(words, range(1, len(words) + 1)))
        self.new = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        self.new.append(word)
        return number


class _Encoder:
    """Ids of texts, and how often each word and id was learned from; word 0 is the end.

    Each word is encoded when it is met and then known by a number. Beyond ``most`` words, or ``most_bytes`` of them,
    the less frequent half is dropped and ``dropped`` gives its counts, so a word's counts may come in several parts.
    """

    def __init__(self, tokenizer_path: str, end_id: int, most: int = 200_000, most_bytes: int = 16 << 20):
        self.encode, self.most, self.most_bytes = encoder(tokenizer_path, 16 << 20), most, most_bytes
        self.kind, self.per_id = _id_type(end_id), np.zeros(end_id + 1, dtype=np.int64)
        one = np.ones(1, dtype=np.int64)
        self._keep([], 0 * one, np.full(1, end_id, self.kind), one, 0 * one)

    def _keep(self, words: list[bytes], times: np.ndarray, ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> None:
        """``times``, ``lengths`` in ids and ``sizes`` in bytes: of each word, the end first."""
        self.words, self.times, self.ids, self.lengths, self.sizes = _Words(words), times, ids, lengths, sizes
        self.starts = np.cumsum(lengths) - lengths

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words and where each one's end."""
        size = self.lengths[numbers]
        stop = np.cumsum(size)
        at = np.repeat(self.starts[numbers] - stop + size, size)
        at += np.arange(len(at))
        return self.ids[at], stop

    def ids_of(self, texts: pa.Array, learned: np.ndarray) -> list[bytes]:
        per, words = words_of(texts)
        words = words.dictionary_encode()
        own = _listed(words.dictionary)
        known = np.fromiter(map(self.words.__getitem__, own), dtype=np.int64, count=len(own))
        if new := self.words.new:
            raw = self.encode.fresh(new)
            lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(raw), "<u4").astype(self.kind)])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, new), dtype=np.int64, count=len(new))])
            self.starts = np.cumsum(self.lengths) - self.lengths
            self.times = np.pad(self.times, (0, len(new)))
            new.clear()
        ends = np.cumsum(per + 1) - 1
        numbers = np.zeros(len(words) + len(per), dtype=np.int64)
        is_word = np.ones(len(numbers), dtype=bool)
        is_word[ends] = False
        numbers[is_word] = known[words.indices.to_numpy()]
        tokens, stop = self._gather(numbers)
        edges = np.append(0, stop[ends])
        self.times += np.bincount(numbers[np.repeat(learned, per + 1)], minlength=len(self.times))
        self.per_id += np.bincount(tokens[np.repeat(learned, np.diff(edges))], minlength=len(self.per_id))
        return [tokens[a:b].tobytes() for a, b in zip(edges.tolist(), edges[1:].tolist())]

    @property
    def full(self) -> bool:
        return len(self.words) > self.most or self.sizes.sum() > self.most_bytes

    def dropped(self, all_: bool = False) -> tuple[list[bytes | None], list[int]]:
        """Words in lower case, the null word standing for the end, and their counts; a word may be there twice."""
        often = np.zeros(len(self.times), dtype=bool)
        if not all_:
            often[np.argsort(-self.times, kind="stable")[: self.most // 2]] = True
            often &= (self.times > 1) & (self.sizes <= 64)
            often[0] = True
        out, words = np.flatnonzero(~often & (self.times > 0)), [b"", *self.words]
        # no word has white space in it
        found = b"\n".join([words[i] for i in out.tolist()]).lower().split(b"\n") if len(out) else []
        if len(out) and out[0] == 0:
            found[0] = None
        times = self.times[out].tolist()
        if all_:
            often[0] = True
            self.times[0] = 0
        kept = np.flatnonzero(often)
        self._keep([words[i] for i in kept[1:].tolist()], self.times[kept], self._gather(kept)[0], self.lengths[kept], self.sizes[kept])
        return found, times


def _listed(words: pa.Array) -> list[bytes]:
    """Words, which hold no white space, as a list; quicker than one by one."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.binary())), b"\n")[0].as_py().split(b"\n")


def _id_type(end_id: int) -> str:
    return "<u2" if end_id < 1 << 16 else "<u4"


def encoded_batches(batches: Iterator[pa.RecordBatch], own: _Encoder, row: int) -> Iterator[pa.RecordBatch]:
    """``encoded``'s rows of one task, from ``row`` on."""
    types = None

    def rows(size: int, cols: dict[str, pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([cols[c] if c in cols else pa.nulls(size, t) for c, t in types.items()], names=list(types))

    def counted(found: tuple[list, list[int]], column: str) -> Iterator[pa.RecordBatch]:
        values, n = found
        for lo in range(0, len(n), 1 << 15):
            times = pa.array(n[lo : lo + (1 << 15)], pa.int64())
            yield rows(len(times), {column: pa.array(values[lo : lo + (1 << 15)], types[column]), "n": times})

    for batch in small_batches(batches):
        types = {"row": pa.int64()} | {f.name: f.type for f in batch.schema} | {"ids": pa.binary(), "word": pa.binary(), "id": pa.int32(), "n": pa.int64()}
        learned = pc.is_valid(batch.column("part")).to_numpy(zero_copy_only=False)
        ids = pa.array(own.ids_of(pc.fill_null(batch.column("text").cast(pa.string()), ""), learned), pa.binary())
        yield rows(batch.num_rows, {f.name: batch.column(f.name) for f in batch.schema} | {"row": pa.array(np.arange(row, row + batch.num_rows), pa.int64()), "ids": ids})
        row += batch.num_rows
        if own.full:
            yield from counted(own.dropped(), "word")
    if types is not None:
        yield from counted(own.dropped(all_=True), "word")
        at = np.flatnonzero(own.per_id)
        yield from counted((at.tolist(), own.per_id[at].tolist()), "id")


def encoded(docs: DataFrame, train_rows: Column, tokenizer_path: str, end_id: int, most_words: int = 200_000) -> DataFrame:
    """One reading of the corpus, written: a row (row, doc_id, k, part, text, ids) of every document, ``part`` being null unless it is
    learned from, and rows (word, n) and (id, n) with the counts of the training documents, which sum up over the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from encoded_batches(batches, _Encoder(tokenizer_path, end_id, most_words), TaskContext.get().partitionId() << 33)

    kind = docs.schema["doc_id"].dataType.simpleString()
    hashed = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.lit("lm")))
    part = F.when(train_rows, F.pmod(F.xxhash64("text"), F.lit(ROUNDS)).cast("int"))
    read = docs.select("doc_id", hashed.alias("k"), part.alias("part"), "text")
    return materialize(read.mapInArrow(run, f"row long, doc_id {kind}, k long, part int, text string, ids binary, word binary, id int, n long"), "encoded")


def frequent_floor(counts: DataFrame, most: int) -> int:
    """The smallest power-of-two-sixteenth step of counts that ``most`` words at most reach."""
    step = F.floor(F.log2("n") * 16)
    found = counts.where("word is not null").groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # at most 16 * 63 steps
    total, floor = 0, None
    for row in found:
        total += row["count"]
        if total > most:
            break
        floor = row["step"]
    return 1 << 62 if floor is None else int(np.ceil(2 ** (floor / 16) - 1e-9))


def id_counts(rows: DataFrame, end_id: int) -> np.ndarray:
    """Occurrences of every id over all training documents of ``encoded``."""
    got = rows.where("id is not null").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # end_id + 1 rows at most
    out = np.zeros(end_id + 1)
    out[got["id"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=float)
    return out


def score(docs: DataFrame, train_rows: Column, tokenizer_path: str, end_id: int, max_docs: int = 1500, max_windows: int = 64, broadcast_words: int = 200_000) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    rows = encoded(docs, train_rows, tokenizer_path, end_id)
    counts = materialize(rows.where("n is not null and id is null").groupBy("word").agg(F.sum("n").alias("n")), "word_counts")
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("ends")).first()
    total, distinct, ends = sums["n"] or 0, sums["v"], sums["ends"] or 0
    floor = frequent_floor(counts, broadcast_words)
    top = counts.where(F.col("word").isNotNull() & (F.col("n") >= floor)).toPandas()  # broadcast_words rows at most

    model = spark.sparkContext.broadcast(_fit(rows, end_id, id_counts(rows, end_id), max_docs, max_windows))
    frequent = pa.array(map(bytes, top["word"]), pa.binary()).cast(pa.string())
    known = spark.sparkContext.broadcast((frequent, np.append(np.log10(top["n"].to_numpy() + 1.0), 0.0)))
    end_value, whole, ids_type = float(np.log10(ends + 1.0)), bool(ends), _id_type(end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (frequent, value), lm = known.value, model.value
        keep_memory()
        for batch in small_batches(batches):
            per, words = words_of(pc.ascii_lower(batch.column("text").cast(pa.string())))
            place = pc.fill_null(pc.index_in(words, value_set=frequent), len(frequent)).to_numpy()
            owner, unknown = np.repeat(np.arange(len(per)), per), np.flatnonzero(place == len(frequent))
            n_unknown = np.bincount(owner[unknown], minlength=len(per))
            found = words.take(pa.array(unknown)).dictionary_encode()
            cells, times = np.unique(owner[unknown] * max(1, len(found.dictionary)) + found.indices.to_numpy(), return_counts=True)
            of, word = np.divmod(cells, max(1, len(found.dictionary)))
            edges = pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=len(per)))), pa.int32())
            cols = [
                batch.column("row"), batch.column("doc_id"), pa.array(per + 1, pa.int64()), pa.array(per - n_unknown + whole, pa.int64()),
                pa.array(end_value + np.bincount(owner, weights=value[place], minlength=len(per)), pa.float64()), pa.array(score_ids(lm, _sequences(batch, ids_type)), pa.float64()),
                pa.ListArray.from_arrays(edges, found.dictionary.cast(pa.binary()).take(pa.array(word))), pa.ListArray.from_arrays(edges, pa.array(times, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["row", "doc_id", "n_tokens", "n_known", "base", "score", "rare", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = materialize(rows.where("ids is not null").select("row", "doc_id", "text", "ids").mapInArrow(run, f"row long, doc_id {kind}, n_tokens long, n_known long, base double, score double, rare array<binary>, times array<int>"), "scored")
    rare = seen.select("row", F.explode(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("times"))).alias("r")).select("row", "r.word", "r.times")
    counted = counts.where(F.col("word").isNotNull() & (F.col("n") < floor))
    added = rare.join(counted.hint("shuffle_hash"), "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("extra"))
    out = seen.drop("rare", "times").join(added, "row", "left")
    per_token = float(np.log10(total + distinct + 1.0))
    zero = F.lit(0)
    return out.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more", zero)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("extra", F.lit(0.0)) - F.col("n_tokens") * per_token).alias("base_score"), "score",
    )


def summed(rows: DataFrame, fan: int = 8) -> tuple[float, np.ndarray]:
    """Sums of ``n`` and of the float64 vectors ``x`` of a (n, x) frame, a row for each task: ``fan`` tasks add them up, the driver adds theirs."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0.0, None
        for batch in batches:
            for own, raw in zip(batch.column("n").to_pylist(), batch.column("x")):
                x = np.frombuffer(raw.as_buffer(), "<f8")
                n, total = n + own, x.copy() if total is None else total + x
        if total is not None:
            yield _vector(n, total)

    got = rows.repartition(fan).mapInArrow(add, "n double, x binary").collect()
    return sum(r.n for r in got), sum((np.frombuffer(r.x, "<f8") for r in got), np.zeros(0) if not got else 0.0)


def _vector(n: float, x: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.float64()), pa.array([x.astype("<f8").tobytes()], pa.binary())], names=["n", "x"])


def _sequences(batch: pa.RecordBatch, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in batch.column("ids").to_pylist()]


def neighbours_of_all(rows: DataFrame, rank: np.ndarray, size: int) -> np.ndarray:
    """``neighbours`` over the ``ids`` of all rows; ``rank`` gives each id's rank."""
    shared, kind = rows.sparkSession.sparkContext.broadcast(rank), _id_type(len(rank) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, of = np.zeros((size, 2 * KINDS)), shared.value
        for batch in small_batches(batches, column="ids"):
            near += neighbours([of[s] for s in _sequences(batch, kind)], size)
        yield _vector(1.0, near.ravel())

    _, near = summed(rows.select("ids").mapInArrow(count, "n double, x binary"))
    return near.reshape(size, 2 * KINDS) if len(near) else np.zeros((size, 2 * KINDS))


def _gradients_of(p: dict, inputs: np.ndarray, targets: np.ndarray, part: int = 256) -> dict[str, np.ndarray]:
    """``_gradients`` of a batch, ``part`` windows at a time, as many as stay in a core's cache."""
    real, total, laid = max(1, int((targets >= 0).sum())), {}, _Laid.of(p)
    for lo in range(0, len(inputs), part):
        own = targets[lo : lo + part]
        _, g = _gradients(p, inputs[lo : lo + part], own, laid, with_loss=False)
        share = np.float32((own >= 0).sum() / real)
        total = {name: total[name] + share * g[name] if total else share * g[name] for name in g}
    return total


def learn_rows(rows: DataFrame, model: AttentionModel, rate: float = 0.01, held: int = 8192) -> None:
    """Train ``model`` on every window of the ``ids`` of all rows, in ROUNDS rounds by ``part``."""
    spark, names, kind = rows.sparkSession, list(model.params), _id_type(len(model.slot) - 1)
    shapes = [model.params[n].shape for n in names]
    edges = np.cumsum([0] + [int(np.prod(s)) for s in shapes])
    for part in range(ROUNDS):
        start, own_rate = spark.sparkContext.broadcast((model.params, model.slot)), rate * (1 - part / ROUNDS)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shared, slots = start.value
            keep_memory()
            p = {n: v.copy() for n, v in shared.items()}
            adam, rng = Adam([p[n] for n in names], own_rate), np.random.default_rng(TaskContext.get().partitionId())
            waiting, learned = [], 0

            def steps() -> int:
                x, y = (np.concatenate(z) for z in zip(*waiting))
                order, batch = rng.permutation(len(x)), int(np.clip(len(x) // 16, 32, 512))
                for at in np.array_split(order, -(-len(x) // batch)):
                    g = _gradients_of(p, x[at], y[at])
                    adam.step([g[n] for n in names])
                waiting.clear()
                return len(x)

            for batch in small_batches(batches, column="ids"):
                waiting.append(windows_of([slots[s] for s in _sequences(batch, kind)], model_outside)[:2])
                if sum(len(x) for x, _ in waiting) >= held:
                    learned += steps()
            if waiting:
                learned += steps()
            if learned:
                yield _vector(learned, learned * np.concatenate([p[n].ravel() for n in names]))

        model_outside = model.outside
        n, total = summed(rows.where(F.col("part") == part).select("ids").mapInArrow(learn, "n double, x binary"))
        if n:
            mean = (total / n).astype(np.float32)
            model.params = {name: mean[a:b].reshape(shape) for name, shape, a, b in zip(names, shapes, edges, edges[1:])}
        start.unpersist()


def _fit(rows: DataFrame, end_id: int, counts: np.ndarray, max_docs: int, max_windows: int) -> AttentionModel:
    rows, kind = rows.where("part is not null"), _id_type(end_id)
    frequent, rank = frequent_ids(counts, end_id)
    near = neighbours_of_all(rows, rank, len(frequent))

    keyed = rows.where("k is not null").select("k", "ids")
    cut = hash_cut(keyed.select("k"), max_docs)
    most = 4 * max_windows * STRIDE  # ids of a document that the start's sample takes to the driver

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, column="ids"):
            own, rng = _sequences(batch, kind), np.random.default_rng(batch.num_rows)
            at = [int(rng.integers(0, max(1, len(x) - most + 1))) for x in own]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array([x[a : a + most].tobytes() for x, a in zip(own, at)], pa.binary())], names=["k", "ids"])

    sequences: list[np.ndarray] = []
    if cut is not None:
        got = keyed.where(F.col("k") <= cut).mapInArrow(stretch, "k long, ids binary").dropDuplicates(["k"]).orderBy("k").limit(max_docs).toPandas()
        sequences = [np.frombuffer(x, kind) for x in got["ids"]]
    model = train(sequences, counts, end_id, max_windows, near=near)
    learn_rows(rows, model)
    return model
