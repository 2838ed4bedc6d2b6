"""Exact substring dedup over bytes by a distributed sparse suffix array.

A byte goes when it lies in a string of ``window`` bytes that also starts in a
document with a smaller id. The suffixes that are sorted start at anchors: of the
strings of ``lead`` bytes in a window, the one with the least hash (the first of
equals). A window's anchor depends on its bytes alone, so equal windows have equal
suffixes at their anchors and equal bytes before them, and one suffix stands for
all the windows in a row that share it (a spot).

1. A suffix whose leading bytes occur in one text only matches nothing. Tasks send
   each 32-bit code of the leading bytes once, with its text, to the code's bucket;
   codes that two texts of a task share are settled there.
2. Splitters, sampled from the suffixes that are left, range-partition them by
   their leading bytes, then by all their bytes. Equal spots are joined in the task
   first (one with the smallest id travels), so the splitters cut hot suffixes too.
3. A bucket sorts its suffixes by multikey quicksort over characters of 8 bytes.
   Neighbours that agree wholly give a spot's smallest document. Where different
   spots share the leading bytes, their windows are sorted the same way, and
   neighbours give each window's smallest document.
4. Leading bytes that a splitter cuts stand in several buckets: their windows are
   compared across boundaries, by the smallest document that each bucket has for one.
5. The removed windows of a document are joined back to its text.

Copies of whole texts are recognised by their md5 first and take no further part.

Cases: a null text is empty. A text under ``window`` bytes keeps all. Texts of any
length are read whole (in overlapping stretches). Rows with one id are one
document: they remove nothing from each other. A row without an id removes
nothing and keeps all. Repeated rows are returned as often as they occur. Other
columns are ignored; an empty table gives no rows. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import hash_cut, materialize, small_batches

_STRETCH = 1 << 19  # windows hashed at a time; places within fit _PLACE bits
_PLACE = np.uint64((1 << 22) - 1)
CODES, DONE, SPOTS = 0, 1, 2


def lead_bytes(window: int) -> int:
    """The leading bytes of a suffix: whole characters of 8 bytes, up to half a window."""
    if window < 16:
        raise ValueError("windows of 16 bytes or more")
    return window // 2 // 8 * 8


# --- anchors ----------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _constants() -> tuple[np.ndarray, int, int]:
    """A 64-bit number for each byte, an odd base and its inverse."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    base = 0xD1342543DE82EF95
    return x ^ (x >> np.uint64(31)), base, pow(base, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    _, base, inverse = _constants()
    return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)])) for b in (base, inverse))


def _spots_of(data: np.ndarray, part: np.ndarray, window: int, lead: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, code) of each spot of some bytes; windows lie in one part each."""
    n = len(data)
    if n < window:
        return (np.zeros(0, np.int64),) * 4
    power, inverse = _powers(_STRETCH + window)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_constants()[0][data] * power[:n], out=sums[1:])
    code = sums[lead:] - sums[:-lead]
    code *= inverse[: len(code)]
    code ^= code >> np.uint64(31)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    code ^= code >> np.uint64(32)
    least = (code & ~_PLACE) | np.arange(len(code), dtype=np.uint64)
    have, want = 1, window - lead + 1
    while 2 * have <= want:  # the least of 1, 2, 4, ... neighbours
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < want:
        least = np.minimum(least[: have - want], least[want - have :])
    anchor = (least & _PLACE).astype(np.int64)
    whole = part[: len(anchor)] == part[window - 1 :]
    new = np.ones(len(anchor), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1] | (part[1 : len(anchor)] != part[: len(anchor) - 1])
    first = np.flatnonzero(new & whole)
    stop = np.append(new | ~whole, True)
    ends = np.flatnonzero(stop)
    last = ends[np.searchsorted(ends, first, side="right")] - 1
    return first, last, anchor[first], code[anchor[first]].view(np.int64)


def spots(texts: list[bytes], window: int, lead: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text's index, first window, last window, anchor, code) of every spot of every text, in bounded pieces of them all."""
    pieces, room = [], _STRETCH

    def told():
        data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        sizes = np.array([len(p[2]) for p in pieces])
        part = np.repeat(np.arange(len(pieces)), sizes)
        first, last, anchor, code = _spots_of(data, part, window, lead)
        own = part[first]
        shift = (np.array([p[1] for p in pieces]) - (np.cumsum(sizes) - sizes))[own]
        return np.array([p[0] for p in pieces])[own], first + shift, last + shift, anchor + shift, code

    for i, text in enumerate(texts):
        for lo in range(0, len(text) - window + 1, _STRETCH):
            own = text[lo : lo + _STRETCH + window - 1]
            if room < len(own) and pieces:  # all pieces together are no longer than one may be
                yield told()
                pieces, room = [], _STRETCH
            pieces.append((i, lo, own))
            room -= len(own)
    if pieces:
        yield told()


# --- sorting ----------------------------------------------------------------------------


def multikey_order(columns: list[np.ndarray], small: int = 4096) -> np.ndarray:
    """The order of rows of 8-byte characters by multikey quicksort: rows are parted by one character into
    less, equal and greater; only the equal go on to the next character. Few rows are sorted at once."""
    order = np.arange(len(columns[0]))
    stack = [(0, len(order), 0)]
    while stack:
        lo, hi, depth = stack.pop()
        if hi - lo < 2 or depth == len(columns):
            continue
        own = order[lo:hi]
        if hi - lo <= small:
            order[lo:hi] = _few(columns, own, depth)
            continue
        char = columns[depth][own]
        pivot = np.sort(char[:: max(1, len(char) // 31)])[len(char[:: max(1, len(char) // 31)]) // 2]
        less, equal = char < pivot, char == pivot
        parts = own[less], own[equal], own[~(less | equal)]
        order[lo:hi] = np.concatenate(parts)
        a, b = lo + len(parts[0]), hi - len(parts[2])
        stack += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order


def _few(columns: list[np.ndarray], own: np.ndarray, depth: int) -> np.ndarray:
    """A few rows in order: by one character after the other, those that are still alike among themselves."""
    own = own[np.argsort(columns[depth][own], kind="stable")]
    group = np.zeros(len(own), dtype=np.int64)
    for d in range(depth, len(columns)):
        char = columns[d][own]
        if d > depth:
            open_rows = np.flatnonzero(alike)
            at = open_rows[np.lexsort((char[open_rows], group[open_rows]))]
            own[open_rows], char[open_rows], group[open_rows] = own[at], char[at], group[at]
        new = np.ones(len(own), dtype=bool)
        new[1:] = (char[1:] != char[:-1]) | (group[1:] != group[:-1])
        alike = ~(new & np.append(new[1:], True))
        if not alike.any():
            break
        group = np.cumsum(new)
    return own


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Starts of the groups of equal rows in sorted columns, and the end."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


# --- step 1: which leading bytes several texts have ----------------------------------------


def _short(code: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of a code."""
    code = code.view(np.uint64)
    return (((code >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (code & np.uint64(0xFFFFFFFF))).view(np.int64)


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


_CODE_FIELDS = [("bucket", pa.int64()), ("kind", pa.int32()), ("t", pa.binary()), ("payload", pa.binary())]


def _by_text(code: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(text, kind="stable")
    text, code = text[order], code[order]
    edges = _starts(text)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(text[a]), code[a:b].astype("<i8").tobytes()


def _send_codes(window: int, lead: int, buckets: int, flush_spots: int):
    def settle(names: list[bytes], parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        text, code = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((text, code))
        text, code = text[order], code[order]
        edges = _starts(code, text)
        text, code = text[edges[:-1]], code[edges[:-1]]
        edges = _starts(code)
        many = np.repeat(np.diff(edges) > 1, np.diff(edges))
        rows = [(int.from_bytes(names[i], "little") % buckets, DONE, names[i], codes) for i, codes in _by_text(code[many], text[many])]
        code, text = code[edges[:-1]], text[edges[:-1]]  # codes ascend, so buckets do
        edges = _starts(code >> 32)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own, at = np.unique(text[a:b], return_inverse=True)
            head = np.array([len(own), b - a], dtype="<u4").tobytes()
            payload = head + b"".join(names[i] for i in own.tolist()) + at.astype("<u4").tobytes() + (code[a:b] & 0xFFFFFFFF).astype("<u4").tobytes()
            rows.append((int(code[a] >> 32), CODES, None, payload))
        for lo in range(0, len(rows), 256):
            yield _batch(rows[lo : lo + 256], _CODE_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts, held = {}, [], 0
        for batch in small_batches(batches):
            texts, at = [], []
            for t, text in zip(batch.column("t").to_pylist(), batch.column("text").to_pylist()):
                if t not in names:
                    names[t] = len(names)
                    texts.append(text.encode())
                    at.append(names[t])
            for own, _, _, _, code in spots(texts, window, lead):
                parts.append((np.array(at)[own], _short(code, buckets)))
                held += len(code)
            if held >= flush_spots:
                yield from settle(list(names), parts)
                names, parts, held = {}, [], 0
        if held:
            yield from settle(list(names), parts)

    return run


def _shared_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(t, codes): of each text, the codes that another one has; the rows come by bucket."""
    fields = [("t", pa.binary()), ("codes", pa.binary())]

    def close(bucket: int, payloads: list[bytes]) -> list[tuple]:
        names, texts, codes = {}, [], []
        for p in payloads:
            n, m = np.frombuffer(p, "<u4", 2).tolist()
            own = np.array([names.setdefault(p[8 + 16 * i : 24 + 16 * i], len(names)) for i in range(n)])
            texts.append(own[np.frombuffer(p, "<u4", m, 8 + 16 * n)])
            codes.append(np.frombuffer(p, "<u4", m, 8 + 16 * n + 4 * m))
        if not payloads:
            return []
        text, code = np.concatenate(texts), np.concatenate(codes)
        order = np.lexsort((text, code))
        text, code = text[order], code[order]
        edges = _starts(code)
        many = np.repeat(text[edges[:-1]] != text[edges[1:] - 1], np.diff(edges))
        known = list(names)
        return [(known[i], own) for i, own in _by_text(code[many].astype(np.int64) | (bucket << 32), text[many])]

    now, held = None, []
    for batch in batches:
        out = []
        for bucket, kind, t, payload in zip(*(batch.column(n).to_pylist() for n, _ in _CODE_FIELDS)):
            if kind == DONE:
                out.append((t, payload))
                continue
            if bucket != now:
                out += close(now, held)
                now, held = bucket, []
            held.append(payload)
        yield _batch(out, fields)
    yield _batch(close(now, held), fields)


# --- step 2: spots as rows of characters ---------------------------------------------------


class Layout:
    """A spot as a row of bytes: the suffix at its anchor, the bytes before the anchor outwards, both padded, and their lengths."""

    def __init__(self, window: int):
        self.window, self.lead = window, lead_bytes(window)
        self.right, self.left = -(-window // 8) * 8, -(-(window - self.lead) // 8) * 8
        self.size = self.right + self.left + 8
        self.leads, self.chars = self.lead // 8, self.size // 8

    def rows(self, text: np.ndarray, first: np.ndarray, last: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        out = np.zeros((len(first), self.size), np.uint8)
        right, left = last + self.window - anchor, anchor - first
        at = np.arange(self.right)
        ok = at < right[:, None]
        out[:, : self.right][ok] = text[(anchor[:, None] + at)[ok]]
        at = np.arange(self.left)
        ok = at < left[:, None]
        out[:, self.right : self.right + self.left][ok] = text[(anchor[:, None] - 1 - at)[ok]]
        out[:, -8:] = (right << 32 | left).astype(">u8").view(np.uint8).reshape(-1, 8)
        return out

    def columns(self, rows: np.ndarray) -> list[np.ndarray]:
        return [np.ascontiguousarray(c) for c in np.ascontiguousarray(rows).view(">u8").reshape(-1, self.chars).astype(np.uint64).T]

    def ranges(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes before the anchor, and windows, of each spot."""
        left = (columns[-1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        right = (columns[-1] >> np.uint64(32)).astype(np.int64)
        return left, right + left - self.window + 1

    def windows(self, columns: list[np.ndarray], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Every window of some spots: its spot, its number there, and its characters (those of one group of leading bytes
        are alike in what is left out here: the leading bytes)."""
        left, many = self.ranges(columns)
        spot = np.repeat(np.arange(len(left)), many)
        number = np.arange(len(spot)) - np.repeat(np.cumsum(many) - many, many)
        before = left[spot] - number
        out = [groups[spot].astype(np.uint64) << np.uint64(32) | before.astype(np.uint64)]
        for d in range(self.leads, self.right // 8):
            out.append(columns[d][spot] & _masks()[np.clip(self.window - before - 8 * d, 0, 8)])
        for d in range(self.left // 8):
            out.append(columns[self.right // 8 + d][spot] & _masks()[np.clip(before - 8 * d, 0, 8)])
        return spot, number, out


@lru_cache(maxsize=1)
def _masks() -> np.ndarray:
    """The first 0 to 8 bytes of a character."""
    return np.array([((1 << 64) - 1) ^ ((1 << 8 * (8 - i)) - 1) for i in range(9)], dtype=np.uint64)


def _look(window: int, lead: int, buckets: int):
    """Finished rows, and the others with their text, their spots and a few sample suffixes for the splitters."""
    layout = Layout(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            codes = [np.frombuffer(b"".join(c), "<i8") if c else None for c in batch.column("codes").to_pylist()]
            copies = batch.column("copy").to_pylist()
            found: list[list] = [[] for _ in texts]
            todo = [i for i, c in enumerate(codes) if c is not None and not copies[i]]
            for own, first, last, anchor, code in spots([texts[i] for i in todo], window, lead):
                code, edges = _short(code, buckets), _starts(own)
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    i = todo[own[a]]
                    ok = np.isin(code[a:b], codes[i])
                    found[i].append(np.column_stack([first[a:b], last[a:b], anchor[a:b]])[ok])
            rows = []
            for doc_id, t, text, copy, own in zip(batch.column("doc_id").to_pylist(), batch.column("t").to_pylist(), texts, copies, found):
                own = np.concatenate(own) if own else np.zeros((0, 3), np.int64)
                if not len(own) or copy:
                    gone = len(text) if copy else 0
                    rows.append((doc_id, t, len(text), gone, int(gone > 0), hashlib.sha256(b"" if copy else text).hexdigest(), None, None, None))
                    continue
                some = own[np.unique(np.random.default_rng(int.from_bytes(t[:8], "little")).integers(0, len(own), 4))]
                sample = layout.rows(np.frombuffer(text, np.uint8), *some.T).tobytes()
                rows.append((doc_id, t, len(text), None, None, None, text, own.astype("<i8").tobytes(), sample))
            kinds = [batch.schema.field("doc_id").type, pa.binary(), *[pa.int64()] * 3, pa.string(), *[pa.binary()] * 3]
            yield _batch(rows, list(zip(["doc_id", "t", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "spots", "sample"], kinds)))

    return run


# --- steps 3 and 4 ---------------------------------------------------------------------------

_WINDOWS = 1 << 18  # windows that a bucket compares at a time
_SPOT_FIELDS = [("bucket", pa.int64()), ("kind", pa.int32()), ("t", pa.binary()), ("doc", pa.int64()), ("payload", pa.binary())]
_FOUND_FIELDS = [("slot", pa.int64()), ("what", pa.string()), ("payload", pa.binary())]
_ROW_FIELDS = [("t", pa.binary()), ("doc", pa.int64()), ("ranges", pa.binary())]
_EDGE = np.dtype([("hi", "<u8"), ("lo", "<u8"), ("t", "V16"), ("doc", "<i8"), ("start", "<i8")])
_PACKED = 8 << 20  # bytes of results that a task packs at a time


def _merged(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Ranges sorted by start, joined where they touch."""
    upto = np.maximum.accumulate(hi)
    new = np.append(True, lo[1:] > upto[:-1])
    return np.column_stack([lo[new], upto[np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)]])


def _by_row(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The merged ranges of each row."""
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order], hi[order]
    edges = _starts(row)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(row[a]), _merged(lo[a:b], hi[a:b]).astype("<i8").tobytes()


def _send_spots(window: int, splitters: np.ndarray, flush_spots: int):
    layout = Layout(window)

    def settle(ids: list[tuple], parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        row, first, raw = (np.concatenate(x) for x in zip(*parts))
        doc = np.array([i[1] for i in ids], dtype=np.int64)[row]
        columns = layout.columns(raw)
        order = multikey_order(columns)
        row, first, raw, doc, columns = row[order], first[order], raw[order], doc[order], [c[order] for c in columns]
        edges = _starts(*columns)
        least = np.repeat(np.minimum.reduceat(doc, edges[:-1]), np.diff(edges))
        more = doc > least  # a smaller document of the task has the whole spot
        many = layout.ranges(columns)[1]
        buckets = len(splitters) + 1
        rows = [(int.from_bytes(ids[i][0], "little") % buckets, DONE, *ids[i], r) for i, r in _by_row(row[more], first[more], first[more] + many[more] + window - 1)]
        row, first, raw = row[~more], first[~more], raw[~more]
        cut = np.searchsorted(raw.view(f"S{layout.size}").ravel(), splitters, side="left")
        for bucket, (a, b) in enumerate(zip([0, *cut.tolist()], [*cut.tolist(), len(row)])):
            for lo in range(a, b, 1 << 14):
                hi = min(b, lo + (1 << 14))
                own, at = np.unique(row[lo:hi], return_inverse=True)
                names = b"".join(ids[i][0] for i in own.tolist())
                docs = np.array([ids[i][1] for i in own.tolist()], dtype="<i8").tobytes()
                head = np.array([len(own), hi - lo], dtype="<u4").tobytes()
                rows.append((bucket, SPOTS, None, None, head + names + docs + at.astype("<u4").tobytes() + first[lo:hi].astype("<i8").tobytes() + raw[lo:hi].tobytes()))
        for lo in range(0, len(rows), 64):
            yield _batch(rows[lo : lo + 64], _SPOT_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in small_batches(batches):
            for doc, t, text, own in zip(*(batch.column(c).to_pylist() for c in ("doc", "t", "text", "spots"))):
                data, own = np.frombuffer(text, np.uint8), np.frombuffer(own, "<i8").reshape(-1, 3)
                for lo in range(0, len(own), flush_spots):
                    some = own[lo : lo + flush_spots]
                    parts.append((np.full(len(some), len(ids)), some[:, 0], layout.rows(data, *some.T)))
                    held += len(some)
                    ids.append((t, doc))
                    if held >= flush_spots:
                        yield from settle(ids, parts)
                        ids, parts, held = [], [], 0
        if held:
            yield from settle(ids, parts)

    return run


class Packer:
    """Removed ranges of many rows, or windows of boundaries, packed by slots: a row of output per slot, whatever number of texts."""

    def __init__(self, slots: int):
        self.slots, self.held, self.size = slots, {}, 0

    def add(self, t: bytes, doc: int, ranges: bytes) -> None:
        own = self.held.setdefault(int.from_bytes(t[:6], "little") % self.slots, bytearray())
        own += t + np.array([doc, len(ranges)], dtype="<i8").tobytes() + ranges
        self.size += 32 + len(ranges)

    def add_window(self, digest: bytes, t: bytes, doc: int, start: int) -> None:
        own = self.held.setdefault(int.from_bytes(digest[:6], "little") % self.slots, bytearray())
        own += digest + t + np.array([doc, start], dtype="<i8").tobytes()
        self.size += _EDGE.itemsize

    def rows(self, what: str, whatever: bool = False) -> list[tuple]:
        if not whatever and self.size < _PACKED:
            return []
        out = [(slot, what, bytes(own)) for slot, own in sorted(self.held.items())]
        self.held, self.size = {}, 0
        return out


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(t, doc, ranges) of each row, merged; the packed rows come by slot."""

    def told(held: dict) -> pa.RecordBatch:
        rows = []
        for (t, doc), parts in held.items():
            own = np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)
            rows.append((t, doc, _merged(*own[np.argsort(own[:, 0], kind="stable")].T).astype("<i8").tobytes()))
        return _batch(rows, _ROW_FIELDS)

    now, held = None, {}
    for batch in batches:
        for slot, payload in zip(batch.column("slot").to_pylist(), batch.column("payload").to_pylist()):
            if slot != now:
                yield told(held)
                now, held = slot, {}
            at = 0
            while at < len(payload):
                doc, n = np.frombuffer(payload, "<i8", 2, at + 16).tolist()
                held.setdefault((payload[at : at + 16], doc), []).append(payload[at + 32 : at + 32 + n])
                at += 32 + n
    yield told(held)


def _across(window: int):
    """(t, doc, ranges): windows of boundaries whose smallest document, over all buckets, is smaller than their row's; they come by slot."""

    def told(payloads: list[bytes]) -> pa.RecordBatch:
        own = np.sort(np.frombuffer(b"".join(payloads), _EDGE), order=["hi", "lo"])
        edges = _starts(own["hi"], own["lo"])
        if len(own):
            own = own[own["doc"] > np.repeat(np.minimum.reduceat(own["doc"], edges[:-1]), np.diff(edges))]
        rows = [(t.tobytes(), doc, np.array([at, at + window], dtype="<i8").tobytes()) for t, doc, at in zip(own["t"], own["doc"].tolist(), own["start"].tolist())]
        return _batch(rows, _ROW_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for slot, payload in zip(batch.column("slot").to_pylist(), batch.column("payload").to_pylist()):
                if slot != now:
                    yield told(held)
                    now, held = slot, []
                held.append(payload)
        yield told(held)

    return run


def _compare(window: int, splitters: np.ndarray, slots: int):
    """Removed ranges of rows, packed by slots, and the windows of buckets' boundaries; the rows come by bucket."""
    layout, at_once = Layout(window), _WINDOWS
    cut = {x.tobytes() for x in splitters.view(np.uint8).reshape(-1, layout.size)[:, : layout.lead]}

    def close(payloads: list[bytes], packer: Packer, edges_out: Packer) -> None:
        if not payloads:
            return
        ids, rows, firsts, raws = {}, [], [], []
        for p in payloads:
            n, m = np.frombuffer(p, "<u4", 2).tolist()
            docs = np.frombuffer(p, "<i8", n, 8 + 16 * n).tolist()
            own = np.array([ids.setdefault((p[8 + 16 * i : 24 + 16 * i], docs[i]), len(ids)) for i in range(n)])
            at = 8 + 24 * n
            rows.append(own[np.frombuffer(p, "<u4", m, at)])
            firsts.append(np.frombuffer(p, "<i8", m, at + 4 * m))
            raws.append(np.frombuffer(p, np.uint8, m * layout.size, at + 12 * m).reshape(m, layout.size))
        row, first, names = np.concatenate(rows), np.concatenate(firsts), list(ids)
        columns = layout.columns(np.concatenate(raws))
        del rows, firsts, raws
        order = multikey_order(columns)
        row, first, columns = row[order], first[order], [c[order] for c in columns]
        doc = np.array([i[1] for i in names], dtype=np.int64)[row]
        edges = _starts(*columns)
        least = np.minimum.reduceat(doc, edges[:-1])
        spot = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        many = layout.ranges(columns)[1]
        whole = doc > least[spot]
        gone = [(row[whole], first[whole], first[whole] + many[whole] + window - 1)]
        # different spots with the same leading bytes: their windows
        one = [c[edges[:-1]] for c in columns]
        many, columns = many[edges[:-1]], None
        leads = _starts(*one[: layout.leads])
        group = np.repeat(np.arange(len(leads) - 1), np.diff(leads))
        heads = np.column_stack([c[leads[:-1]] for c in one[: layout.leads]]).astype(">u8")
        border = np.array([h.tobytes() in cut for h in heads], dtype=bool)
        use = np.flatnonzero(((np.diff(leads) > 1) | border)[group])
        # the windows of a spot belong to the rows of its smallest document
        holders = np.flatnonzero(~whole)
        lo_hi = np.searchsorted(spot[holders], np.arange(len(edges)))

        def windows_of(use: np.ndarray) -> None:
            at, number, chars = layout.windows([c[use] for c in one], group[use])
            at = use[at]
            order = multikey_order(chars)
            sets = _starts(*(c[order] for c in chars))
            smallest = np.empty(len(at), dtype=np.int64)
            smallest[order] = np.repeat(np.minimum.reduceat(least[at[order]], sets[:-1]), np.diff(sets))
            bad = smallest < least[at]

            def at_rows(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                n = np.diff(lo_hi)[at[chosen]]
                w = np.repeat(chosen, n)
                r = holders[lo_hi[at[w]] + np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)]
                return w, row[r], first[r] + number[w]

            _, r, start = at_rows(np.flatnonzero(bad))
            gone.append((r, start, start + window))
            w, r, start = at_rows(np.flatnonzero(border[group[at]] & ~bad))
            if len(w):
                flat = np.column_stack([*(one[d][at[w]] for d in range(layout.leads)), chars[0][w] & np.uint64(0xFFFFFFFF), *(c[w] for c in chars[1:])]).astype(">u8")
                for i, s, x in zip(r.tolist(), start.tolist(), flat):
                    edges_out.add_window(hashlib.md5(x.tobytes()).digest(), *names[i], s)

        # groups of equal leading bytes stay together
        upto, lo = np.cumsum(many[use]), 0
        while lo < len(use):
            hi = int(np.searchsorted(upto, upto[lo] + at_once))
            hi = len(use) if hi >= len(use) else int(np.searchsorted(group[use], group[use[hi]], side="left"))
            hi = hi if hi > lo else int(np.searchsorted(group[use], group[use[lo]], side="right"))
            windows_of(use[lo:hi])
            lo = hi
        r, lo, hi = (np.concatenate(x) for x in zip(*gone))
        for i, ranges in _by_row(r, lo, hi):
            packer.add(*names[i], ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, packer, edges_out = None, [], Packer(slots), Packer(-(-slots // 8))
        for batch in batches:
            for bucket, kind, t, doc, payload in zip(*(batch.column(n).to_pylist() for n, _ in _SPOT_FIELDS)):
                if kind == DONE:
                    packer.add(t, doc, payload)
                    continue
                if bucket != now:
                    close(held, packer, edges_out)
                    now, held = bucket, []
                held.append(payload)
            yield _batch(packer.rows("ranges") + edges_out.rows("windows"), _FOUND_FIELDS)
        close(held, packer, edges_out)
        yield _batch(packer.rows("ranges", whatever=True) + edges_out.rows("windows", whatever=True), _FOUND_FIELDS)

    return run


# --- step 5 ------------------------------------------------------------------------------------


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in small_batches(batches):
        rows = []
        for doc_id, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "ranges"))):
            kept, spans, gone, at = [], 0, 0, 0
            if ranges:
                own = np.frombuffer(b"".join(ranges), "<i8").reshape(-1, 2)
                for lo, hi in _merged(*own[np.argsort(own[:, 0], kind="stable")].T).tolist():
                    kept.append(text[at:lo])
                    spans, gone, at = spans + 1, gone + hi - lo, hi
            kept.append(text[at:])
            text_left = b"".join(kept)
            rows.append((doc_id, len(text), gone, spans, hashlib.sha256(text_left).hexdigest(), text_left))
        kinds = [batch.schema.field("doc_id").type, *[pa.int64()] * 3, pa.string(), pa.binary()]
        yield _batch(rows, list(zip(names, kinds)))


def _splitters(open_rows: DataFrame, layout: Layout, buckets: int, max_rows: int) -> np.ndarray:
    """``buckets`` - 1 cuts between the suffixes of a bounded sample of rows: the lowest hashes of their texts."""
    keyed = open_rows.select(F.xxhash64("t").alias("h"), "sample")
    top = hash_cut(keyed.select("h"), max_rows)
    if top is None or buckets < 2:
        return np.zeros(0, f"S{layout.size}")
    sample = b"".join(r["sample"] for r in keyed.where(F.col("h") <= top).dropDuplicates(["h"]).select("sample").collect())
    rows = np.sort(np.frombuffer(sample, f"S{layout.size}"))
    return rows[np.linspace(0, len(rows), buckets + 1)[1:-1].astype(np.int64)]


def dedup(docs: DataFrame, window: int = 50, bucket_bytes: int = 32 << 20, flush_spots: int = 1 << 16, sample_rows: int = 8192) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; ``kept`` holds the bytes left of rows that lost or might have lost some, null elsewhere.

    ``bucket_bytes``: what a bucket's task holds at most of text whose codes it compares (step 1) or of spots (step 3), as long as
    the sample of ``sample_rows`` rows (four suffixes each) is even; ``flush_spots``: what a task joins before it sends.
    """
    layout, lead = Layout(window), lead_bytes(window)
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("t"))
    named = rows.where((F.octet_length("text") >= window) & F.col("doc_id").isNotNull())
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(least, -(-size // bucket_bytes))

    sent = named.select("t", "text").mapInArrow(_send_codes(window, lead, buckets, 4 * flush_spots), "bucket long, kind int, t binary, payload binary")
    shared = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_shared_codes, "t binary, codes binary")
    shared = materialize(shared, "shared_codes")

    ids = materialize(named.select("t", "doc_id").distinct(), "texts")
    firsts = materialize(ids.groupBy("t").agg(F.min("doc_id").alias("first")), "firsts")
    copies = ids.join(firsts, "t").where("doc_id > first").select("t", "doc_id", F.lit(True).alias("copy"))
    found = shared.groupBy("t").agg(F.collect_list("codes").alias("codes")).join(firsts, "t").select("t", F.col("first").alias("doc_id"), F.lit(False).alias("copy"), "codes")
    known = materialize(copies.unionByName(found, allowMissingColumns=True), "known")

    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = rows.join(known, ["t", "doc_id"], "left").mapInArrow(
        _look(window, lead, buckets),
        f"doc_id {kind}, t binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text binary, spots binary, sample binary",
    )
    seen = materialize(seen, "spots")
    open_rows = seen.where("text is not null")
    n_spots = (open_rows.agg(F.sum(F.octet_length("spots"))).first()[0] or 0) // 24
    ranges = max(least, -(-n_spots * layout.size // bucket_bytes))
    splitters = _splitters(open_rows, layout, ranges, sample_rows)

    sent = open_rows.select(F.col("doc_id").cast("long").alias("doc"), "t", "text", "spots").mapInArrow(
        _send_spots(window, splitters, flush_spots), "bucket long, kind int, t binary, doc long, payload binary"
    )
    compared = sent.repartition(ranges, "bucket").sortWithinPartitions("bucket").mapInArrow(_compare(window, splitters, ranges), "slot long, what string, payload binary")
    compared = materialize(compared, "compared")
    by_slot = lambda what: compared.where(F.col("what") == what).select("slot", "payload").repartition(ranges, "slot").sortWithinPartitions("slot")
    removed = "t binary, doc long, ranges binary"
    gone = by_slot("ranges").mapInArrow(_unpacked, removed).unionByName(by_slot("windows").mapInArrow(_across(window), removed))
    gone = materialize(gone.groupBy("t", "doc").agg(F.collect_list("ranges").alias("ranges")), "ranges")

    left = open_rows.select("doc_id", "t", "text", F.col("doc_id").cast("long").alias("doc")).join(gone, ["t", "doc"], "left")
    cut = left.select("doc_id", "text", "ranges").mapInArrow(_cut_out, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    done = seen.where("text is null").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.lit(None).cast("binary").alias("kept"))
    return done.unionByName(cut)
