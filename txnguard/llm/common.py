"""Helpers shared by the text operators: folds, written intermediate tables,
Arrow column access and vectorised n-gram hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.session import work_dir

ASCII_SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str, modulus: int, held: int) -> Column:
    """True where crc32(doc_id as text) mod ``modulus`` is ``held``; a null id is in no held-out fold."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(modulus) == F.lit(held), F.lit(False))


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's shared checkpoint folder and read it back:
    the lineage is cut there, so a lost executor costs a re-read and no recomputation.
    The write's own shuffle files are of no use afterwards and are dropped with it."""
    spark = df.sparkSession
    path = work_dir(spark, "llm", name, unique=True)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def hash_cut(keys: DataFrame, rows: int) -> int | None:
    """The ``rows``-th smallest of the distinct values of ``keys``' one long column, or the largest there is:
    a bounded sample is what lies at or below it, whichever way the rows are dealt out."""
    name = keys.columns[0]
    lowest = keys.distinct().orderBy(name).limit(rows)
    return lowest.agg(F.max(name)).first()[0]


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use (case-insensitively)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = "_" + name
    return name


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of an Arrow batch; null reads as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 4 << 20, max_rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of at most ``max_rows`` rows and about ``max_bytes`` of text (one row at least),
    so that what is computed from a slice stays bounded whatever the batch size of the session."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, lo = np.cumsum(sizes), 0
        while lo < batch.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = int(min(max(np.searchsorted(ends, base + max_bytes, side="right"), lo + 1), lo + max_rows, batch.num_rows))
            yield batch.slice(lo, hi - lo)
            lo = hi


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array], drop: set[str] = frozenset()) -> pa.RecordBatch:
    """``batch`` without ``drop`` and any column that ``new`` replaces, then ``new``."""
    names = [n for n in batch.schema.names if n not in drop and n not in new]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(new.values()), names=names + list(new))


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and all others as U+0100 and on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# --- hashed n-grams -------------------------------------------------------------------

SEGMENT = 1 << 18  # code points hashed at a time; longer texts are cut with an overlap, so no n-gram is lost


def char_ngrams(texts: list[str], sizes: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yield (text index, bucket) of every character n-gram of every text, in bounded chunks.

    ``buckets`` is a power of two. The n-grams never cross from one text to the next.
    """
    reach = max(sizes) - 1
    pieces: list[tuple[int, str, int]] = []  # text index, characters, n-grams that start here
    room = SEGMENT
    for i, text in enumerate(texts):
        for lo in range(0, len(text), SEGMENT):
            own = min(SEGMENT, len(text) - lo)
            pieces.append((i, text[lo : lo + own + reach], own))
            room -= own
            if room <= 0:
                yield from _hash_pieces(pieces, sizes, buckets)
                pieces, room = [], SEGMENT
    if pieces:
        yield from _hash_pieces(pieces, sizes, buckets)


def _hash_pieces(pieces, sizes, buckets):
    points = np.frombuffer("".join(p[1] for p in pieces).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(p[1]) for p in pieces])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    at = np.arange(len(points)) - np.repeat(starts, lengths)
    left = np.repeat(lengths, lengths) - at  # characters from here to the piece's end
    own = at < np.repeat([p[2] for p in pieces], lengths)
    owner = np.repeat(np.array([p[0] for p in pieces], dtype=np.int64), lengths)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    for n in sizes:
        h = np.full(max(0, len(points) - n + 1), n * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
        for j in range(n):
            h = (h ^ points[j : len(points) - n + 1 + j]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        ok = (own & (left >= n))[: len(h)]
        yield owner[: len(h)][ok], ((h[ok] * np.uint32(0xC2B2AE35)) >> shift).astype(np.int64)


def count_matrix(texts: list[str], sizes: tuple[int, ...], buckets: int) -> np.ndarray:
    """Dense (texts x buckets) counts of character n-grams; call it with slices of ``small_batches``."""
    out = np.zeros((len(texts), buckets))
    for owner, bucket in char_ngrams(texts, sizes, buckets):
        out += np.bincount(owner * buckets + bucket, minlength=out.size).reshape(out.shape)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))
