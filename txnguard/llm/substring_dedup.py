"""Exact substring dedup by fixed-block anchors.

A word goes when it lies in a window of ``window`` words that also starts in a
document with a smaller id. Of any such window, the document with the smaller id
holds one whole aligned block of ``window // 2`` words, so:

1. Each task hashes the aligned blocks of its documents (the index) and every
   rolling window of a block's length (the probes). Codes that two documents of
   one task share are settled there; of these only two probes and one block
   travel, so that a passage in a third of all documents stays small. Everything
   else goes to the code's bucket as packed 32-bit codes by document.
2. A bucket's task holds its blocks and streams its probes past them. It returns
   the codes of the probes that hit another document's block, and of the blocks
   that were hit.
3. Around each hit, the document's full windows get 128-bit hashes; their
   smallest document is found by a grouped minimum, which pre-aggregates.
4. The windows whose content starts in a smaller document are joined back; their
   union is the maximal exact repeat that goes.

Whole copies are recognised by their text first and take no part in step 3. All
joins meet tables in the shared folder, so hot keys can be split at run time.

Cases: a null text has no words. Documents of fewer than ``window`` words keep
all. Rows with one id are one document: they remove nothing from each other. A
row without an id removes nothing and keeps all. Repeated rows are returned as
often as they occur; other columns are ignored. Equality of windows and of whole texts
is that of 128-bit hashes; codes of blocks, and the 64-bit keys they travel under, only
propose windows. Texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import materialize, small_batches, texts_of

_R = 0x9E3779B97F4A7C15
BLOCK, PROBE, RUNS = 0, 1, 2


def block_codes(words: list[list[bytes]], block: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every rolling window of ``block`` words: its text's index, its place, and its code (bucket << 32 | 32 bits)."""
    counts = np.array([len(w) for w in words], dtype=np.int64)
    total = int(counts.sum())
    if total < block:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(words)), counts)
    place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for own in words for w in own), dtype=np.uint64, count=total)
    power = np.cumprod(np.full(total, _R, dtype=np.uint64))
    inverse = np.cumprod(np.full(total, pow(_R, -1, 1 << 64), dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power)])
    code = (sums[block:] - sums[:-block]) * inverse[: total - block + 1]
    code = (code ^ (code >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    code ^= code >> np.uint64(32)
    code = ((code >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (code & np.uint64(0xFFFFFFFF))
    whole = owner[: len(code)] == owner[block - 1 :]
    return owner[: len(code)][whole], place[: len(code)][whole], code[whole].view(np.int64)


def window_hashes(words: list[bytes], starts: np.ndarray, window: int) -> np.ndarray:
    """128-bit hashes of the windows at ``starts``, as (n, 2) longs."""
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(joined[a:b]) for a, b in zip(first[starts].tolist(), ends[starts + window - 1].tolist())])
    return np.frombuffer(raw, dtype="<i8").reshape(-1, 2)


def _runs(at: np.ndarray) -> bytes:
    """Ascending places as (start, end) pairs."""
    cut = np.flatnonzero(np.diff(at) != 1)
    return np.column_stack([at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]] + 1]).astype("<i8").tobytes()


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Starts of the groups of equal keys in sorted columns, and the end."""
    if not len(keys[0]):
        return np.zeros(1, np.int64)
    change = np.zeros(len(keys[0]), dtype=bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    change[0] = True
    return np.append(np.flatnonzero(change), len(change))


def _pack(kind: int, code: np.ndarray, key: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Rows (bucket, kind, payload) of codes by document; a payload is documents, their keys, their counts, the 32-bit codes."""
    bucket = code >> 32
    order = np.lexsort((key, bucket))
    bucket, code, key = bucket[order], code[order], key[order]
    edges = _groups(bucket)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        docs = _groups(key[lo:hi])
        head = np.array([len(docs) - 1], dtype="<u4").tobytes()
        yield int(bucket[lo]), kind, head + key[lo:hi][docs[:-1]].astype("<i8").tobytes() + np.diff(docs).astype("<u4").tobytes() + (code[lo:hi] & 0xFFFFFFFF).astype("<u4").tobytes()


def _unpack(bucket: int, payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(payload, "<u4", 1)[0])
    keys, counts = np.frombuffer(payload, "<i8", n, 4), np.frombuffer(payload, "<u4", n, 4 + 8 * n)
    return np.frombuffer(payload, "<u4", -1, 4 + 12 * n).astype(np.int64) | (bucket << 32), np.repeat(keys, counts)


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _emit(window: int, block: int, buckets: int, flush_windows: int):
    names, types = ["bucket", "kind", "doc", "payload"], [pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def settle(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, place, code = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((place, key, code))
        key, place, code = key[order], place[order], code[order]
        edges = _groups(code)
        size = np.diff(edges)
        shared = np.repeat(key[edges[:-1]] != key[edges[1:] - 1], size)  # keys are sorted within a code
        pair = np.ones(len(code), dtype=bool)  # first of its code and document
        pair[1:] = (code[1:] != code[:-1]) | (key[1:] != key[:-1])
        lead = np.zeros(len(code), dtype=bool)  # the first and the last document of each code stand for all
        lead[edges[:-1]] = True
        last = np.flatnonzero(pair)
        last = last[np.append(code[last][1:] != code[last][:-1], True)]
        lead[last] = True
        aligned = place % block == 0
        at = np.flatnonzero(pair & (~shared | lead))
        rows = [(b, k, None, p) for b, k, p in _pack(PROBE, code[at], key[at])]
        at = np.flatnonzero(aligned)
        at = at[_groups(code[at], key[at])[:-1]]
        own = ~shared[at]
        own[_groups(code[at])[:-1]] = True
        rows += [(b, k, None, p) for b, k, p in _pack(BLOCK, code[at[own]], key[at[own]])]
        at = np.flatnonzero(shared)
        at = at[np.lexsort((place[at], key[at]))]
        docs = _groups(key[at])
        # settled codes go wherever their document's rows are dealt: any bucket passes them on
        rows += [(int(key[at[a]] % buckets), RUNS, int(key[at[a]]), _runs(place[at[a:b]])) for a, b in zip(docs[:-1].tolist(), docs[1:].tolist())]
        for lo in range(0, len(rows), 256):
            yield _table(rows[lo : lo + 256], names, types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in small_batches(batches):
            keys = batch.column("key").to_numpy()
            words = [t.encode().split() for t in texts_of(batch)]
            words = [w if len(w) >= window else [] for w in words]
            owner, place, code = block_codes(words, block, buckets)
            parts.append((keys[owner], place, code))
            held += len(code)
            if held >= flush_windows:
                yield from settle(parts)
                parts, held = [], 0
        if held:
            yield from settle(parts)

    return run


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of each bucket; the rows come sorted by bucket, blocks before probes."""
    names, types = ["doc", "runs", "codes"], [pa.int64(), pa.binary(), pa.binary()]
    now, parts, index = None, [], None

    def close() -> list[tuple]:
        if index is None:
            return []
        code, key, edges, many, hit = index
        return by_doc(code, key, np.repeat(hit | many, np.diff(edges)))

    def by_doc(code, key, ok) -> list[tuple]:
        code, key = code[ok], key[ok]
        order = np.argsort(key, kind="stable")
        code, key = code[order], key[order]
        docs = _groups(key)
        return [(int(key[a]), None, code[a:b].astype("<i8").tobytes()) for a, b in zip(docs[:-1].tolist(), docs[1:].tolist())]

    for batch in batches:
        out = []
        for bucket, kind, doc, payload in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "doc", "payload"))):
            if bucket != now:
                out += close()
                now, parts, index = bucket, [], None
            if kind == RUNS:
                out.append((doc, payload, None))
                continue
            code, key = _unpack(bucket, payload)
            if kind == BLOCK:
                parts.append((code, key))
                continue
            if index is None:
                if not parts:
                    continue
                code_b, key_b = (np.concatenate(x) for x in zip(*parts))
                order = np.lexsort((key_b, code_b))
                code_b, key_b = code_b[order], key_b[order]
                edges = _groups(code_b)
                index, parts = (code_b, key_b, edges, key_b[edges[:-1]] != key_b[edges[1:] - 1], np.zeros(len(edges) - 1, dtype=bool)), []
            code_b, key_b, edges, many, hit = index
            first = code_b[edges[:-1]]
            at = np.minimum(np.searchsorted(first, code), len(first) - 1)
            ok = (first[at] == code) & (many[at] | (key_b[edges[:-1]][at] != key))
            hit[at[ok]] = True
            out += by_doc(code, key, ok)
        yield _table(out, names, types)
    yield _table(close(), names, types)


def _candidates(window: int, block: int, buckets: int):
    names = ["doc_id", "key", "n_words", "n_removed", "kept_sha256", "text", "hi", "lo"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = []
            texts = texts_of(batch)
            for text, doc_id, key, copy_of, runs, codes in zip(texts, *(batch.column(c).to_pylist() for c in ("doc_id", "key", "copy_of", "runs", "codes"))):
                words = text.encode().split()
                copy = copy_of is not None and hashlib.md5(text.encode()).hexdigest() == copy_of
                if len(words) < window or not (copy or runs or codes):
                    rows.append((doc_id, key, len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest(), None, None, None))
                elif copy:
                    rows.append((doc_id, key, len(words), len(words), hashlib.sha256(b"").hexdigest(), None, None, None))
                else:
                    _, _, own = block_codes([words], block, buckets)
                    hit = np.isin(own, np.frombuffer(b"".join(codes), "<i8")) if codes else np.zeros(len(own), dtype=bool)
                    for a, b in np.frombuffer(b"".join(runs), "<i8").reshape(-1, 2).tolist():
                        hit[a:b] = True
                    # a full window is a candidate if a hit lies within it
                    before = np.concatenate([[0], np.cumsum(hit)])
                    n = len(words) - window + 1
                    starts = np.flatnonzero(before[np.arange(n) + window - block + 1] > before[:n])
                    found = np.unique(window_hashes(words, starts, window), axis=0)
                    rows.append((doc_id, key, len(words), None, None, text, found[:, 0], found[:, 1]))
            longs = pa.list_(pa.int64())
            yield _table(rows, names, [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), longs, longs])

    return run


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = []
            for text, doc_id, bad in zip(texts_of(batch), batch.column("doc_id").to_pylist(), batch.column("bad").to_pylist()):
                words = text.encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                if bad:
                    known = np.frombuffer(b"".join(bad), dtype="S16")
                    starts = np.arange(len(words) - window + 1)
                    starts = starts[np.isin(window_hashes(words, starts, window).astype(">i8").view("S16").ravel(), known)]
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + window, -1)
                kept = [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]
                text = b" ".join(kept)
                rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest(), text.decode()))
            yield _table(rows, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"], [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.string(), pa.string()])

    return run


def dedup(docs: DataFrame, window: int = 50, bucket_bytes: int = 256 << 20, flush_windows: int = 2_000_000) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row; ``kept`` is the text left of rows that lost or may lose words, null elsewhere.

    ``bucket_bytes``: the text whose codes share a bucket at most, which bounds what a task of step 2
    holds (the codes of one block in 25 words); there are at least as many buckets as shuffle partitions.
    """
    block = window // 2
    rows = docs.select("doc_id", "text").withColumn("key", F.xxhash64("doc_id", "text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))
    named = rows.where("doc_id is not null and text is not null")

    dealt = named.select("key", "text").mapInArrow(_emit(window, block, buckets, flush_windows), "bucket long, kind int, doc long, payload binary")
    hits = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_probe, "doc long, runs binary, codes binary")
    hits = materialize(hits, "hits")

    ids = materialize(named.select("key", "doc_id", F.md5(F.col("text").cast("binary")).alias("t")).distinct(), "texts")
    firsts = materialize(ids.groupBy("t").agg(F.min("doc_id").alias("first")), "firsts")
    copies = ids.join(firsts, "t").where("doc_id > first").select(F.col("key").alias("doc"), F.col("t").alias("copy_of"))
    # the text's md5 tells whether a row is the copy that its key names
    found = hits.unionByName(copies, allowMissingColumns=True)
    found = found.groupBy("doc").agg(F.max("copy_of").alias("copy_of"), F.collect_list("runs").alias("runs"), F.collect_list("codes").alias("codes"))
    found = materialize(found.select(F.col("doc").alias("key"), "copy_of", "runs", "codes"), "found")

    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = rows.join(found, "key", "left").mapInArrow(
        _candidates(window, block, buckets), f"doc_id {kind}, key long, n_words long, n_removed long, kept_sha256 string, text string, hi array<long>, lo array<long>"
    )
    seen = materialize(seen, "candidates")
    windows = seen.where("text is not null").select("key", "doc_id", F.explode(F.arrays_zip("hi", "lo")).alias("w")).select("key", "doc_id", "w.hi", "w.lo")
    least = windows.groupBy("hi", "lo").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first")
    least = materialize(least.drop("last"), "least")
    bad = materialize(windows.join(least, ["hi", "lo"]).where("doc_id > first").select("key", "doc_id", "hi", "lo"), "repeats")
    # both halves of a hash as 16 bytes, the highest first
    raw = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    bad = bad.select("key", "doc_id", F.concat(raw("hi"), raw("lo")).alias("w"))
    bad = materialize(bad.groupBy("key", "doc_id").agg(F.collect_set("w").alias("bad")), "removed")
    open_rows = seen.where("text is not null").select("key", "doc_id", "text").join(bad, ["key", "doc_id"], "left").drop("key")
    cut = open_rows.mapInArrow(_remove(window), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept string")
    done = seen.where("text is null").select("doc_id", "n_words", "n_removed", "kept_sha256", F.lit(None).cast("string").alias("kept"))
    return done.unionByName(cut)
