"""Sequence packing: bounded-space online best-fit.

Each task tokenises its documents and packs their pieces as they come into at
most ``open_bins`` open sequences. The open sequences sit in a bitset keyed by
free space, so the best fit is the lowest set bit at or above a piece's length;
when a new sequence is needed and all places are taken, the fullest closes. What
a task leaves open is packed again with what a bounded group of other tasks
left, the largest first, so that small inputs per task cost few extra sequences.

Cases: a null text is an empty one and still holds the end id. A document over
``capacity`` tokens is cut into full pieces and one last shorter piece; shorter
documents are never cut. Repeated rows are packed as often as they occur. Other
columns of the input are ignored. An empty table gives no rows. Of sequences with equal
free space, the one that got it last is filled first. Texts of any length are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from txnguard.llm.common import materialize, small_batches, texts_of
from txnguard.llm.subwords import encoder

_BINS = 32  # bits of a sequence id that number a task's own sequences


class BestFit:
    """Open bins by free space: ``bits`` has bit f set where ``bins[f]`` is not empty."""

    def __init__(self, capacity: int, open_bins: int | None):
        self.capacity, self.open_bins, self.bits, self.count, self.made = capacity, open_bins, 0, 0, 0
        self.bins: dict[int, list[int]] = {}

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) for an item; the bins are numbered as they open."""
        fits = self.bits >> size
        if fits:
            free = size + ((fits & -fits).bit_length() - 1)
            bin_id = self._take(free)
        else:
            if size < self.capacity and self.open_bins and self.count >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, bin_id = self.capacity, self.made
            self.made += 1
        if free > size:
            self.bins.setdefault(free - size, []).append(bin_id)
            self.bits |= 1 << (free - size)
            self.count += 1
        return bin_id, self.capacity - free

    def _take(self, free: int) -> int:
        own = self.bins[free]
        bin_id = own.pop()
        if not own:
            self.bits &= ~(1 << free)
        self.count -= 1
        return bin_id

    def open(self) -> dict[int, int]:
        """Used space of each open bin."""
        return {b: self.capacity - free for free, own in self.bins.items() for b in own}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, open_bins: int = 1024, group: int = 64, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ``ids`` on request).

    ``group``: so many tasks' open sequences meet in one task of the second round,
    which therefore handles ``group * open_bins`` sequences at most.
    """
    end, id_arrow = end_id.to_bytes(4, "little"), to_arrow_type(docs.schema["doc_id"].dataType)

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = encoder(tokenizer_path), BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << _BINS
        for batch in small_batches(batches):
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts_of(batch))):
                ids += end
                for piece, lo in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[lo : lo + 4 * capacity]
                    bin_id, offset = bins.place(len(own) // 4)
                    out.append((doc_id, piece, lo // 4, len(own) // 4, zlib.crc32(own), base + bin_id, offset, None, own))
            yield _rows(out, id_arrow, with_ids)
        out = [(None, None, None, None, None, base + b, None, used, b"") for b, used in sorted(bins.open().items())]
        if out:
            yield _rows(out, id_arrow, with_ids)

    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "sequence_id", "offset", "used")]
        + [T.StructField("ids", T.BinaryType())] * with_ids
    )
    placed = materialize(docs.select("doc_id", "text").mapInArrow(first_round, schema), "packing")
    pieces = placed.where("used is null").drop("used")
    left = placed.where("used is not null").select("sequence_id", "used")

    def second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bins, names = None, None, []
        for batch in batches:
            out = []
            for key, old, used in zip(*(batch.column(c).to_pylist() for c in ("lot", "sequence_id", "used"))):
                if key != current:
                    current, bins, names = key, BestFit(capacity, None), []
                bin_id, offset = bins.place(used)
                if bin_id == len(names):
                    names.append(old)  # a sequence keeps the number of the first one in it
                out.append((old, names[bin_id], offset))
            cols = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["sequence_id", "into", "shift"])

    lots = left.withColumn("lot", F.floor(F.shiftright("sequence_id", _BINS) / group))
    moved = lots.repartition("lot").sortWithinPartitions("lot", F.desc("used"), "sequence_id").mapInArrow(second_round, "sequence_id long, into long, shift long")
    moved = moved.where("sequence_id <> into")
    out = pieces.join(moved, "sequence_id", "left")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "sequence_id").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")]
    return out.select(*columns, *(["ids"] if with_ids else []))


def _rows(out: list[tuple], id_type: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "used", "ids"]
    types = [id_type, pa.int32(), *[pa.int64()] * 6, pa.binary()]
    cols = list(zip(*out)) or [[]] * 9
    n = 9 if with_ids else 8
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols[:n], types[:n])], names=names[:n])
