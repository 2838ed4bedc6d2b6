"""Linear models on hashed n-gram counts, fitted in numpy on bounded samples of dense or sparse rows."""

from __future__ import annotations

import numpy as np

from txnguard.llm.common import sigmoid


def unit_rows(counts: np.ndarray) -> np.ndarray:
    """Square roots of the counts, each row scaled to length 1; a row without counts stays zero."""
    x = np.sqrt(counts)
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)


_ENTRY = np.dtype([("at", "<u2"), ("value", "<f4")])  # of at most 65,536 columns


def packed(row: np.ndarray) -> bytes:
    """The entries of a dense row that are not zero."""
    at = np.flatnonzero(row)
    out = np.empty(len(at), dtype=_ENTRY)
    out["at"], out["value"] = at, row[at]
    return out.tobytes()


class SparseRows:
    """``packed`` rows; an index array gives those rows as a dense matrix, so a mini-batch at a time is dense."""

    def __init__(self, rows: list[bytes], columns: int):
        self.rows, self.shape = rows, (len(rows), columns)

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), self.shape[1]), dtype=np.float32)
        for row, i in zip(out, at):
            own = np.frombuffer(self.rows[i], dtype=_ENTRY)
            row[own["at"]] = own["value"]
        return out

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        own = (np.frombuffer(row, dtype=_ENTRY) for row in self.rows)
        return np.fromiter((x["value"] @ w[x["at"]] for x in own), dtype=np.float32, count=len(self))

    def only(self, mask: np.ndarray) -> SparseRows:
        return SparseRows([row for row, take in zip(self.rows, mask) if take], self.shape[1])


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


def fit_logistic(x: np.ndarray | SparseRows, y: np.ndarray, weight: np.ndarray | None = None, epochs: int = 40, rate: float = 0.05, l2: float = 1e-5, batch: int = 256, seed: int = 7) -> tuple[np.ndarray, float]:
    """Logistic regression by mini-batch Adam; ``weight`` per row."""
    w, b = np.zeros(x.shape[1], dtype=np.float32), np.zeros(1, dtype=np.float32)
    weight = np.ones(len(x), dtype=np.float32) if weight is None else weight.astype(np.float32)
    adam, rng = Adam([w, b], rate), np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            at = order[lo : lo + batch]
            g = (weight[at] * (sigmoid(x[at] @ w + b) - y[at])).astype(np.float32) / len(at)
            adam.step([x[at].T @ g + l2 * w, g.sum(keepdims=True)])
    return w, float(b[0])


def platt(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities: Newton steps on smoothed targets."""
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, c = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * margin + c)
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        h = p * (1 - p)
        m = np.array([[(h * margin**2).sum() + 1e-6, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, g)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(c)) if a > 0 else (1.0, 0.0)
