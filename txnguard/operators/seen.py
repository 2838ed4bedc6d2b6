"""Dedup against history (D9): an index of seen transaction ids with Bloom filters.

Ids are dealt into buckets by hash. The index is a Parquet table partitioned by
bucket; beside it every bucket has a Bloom filter, stored as bitmaps of 32,768 bits
(Spark's bitmap aggregates), so a filter is a few small rows that merge by OR. A
delivery asks the filters first: ids that some filter bit rules out are new without
a look at the index, and only buckets that may hold one of the delivery's ids are
read, by partition pruning. A delivery costs what it holds and what it meets again,
not the history.

Files of a delivery are written once under its own name (``delivery``), and a
delivery that runs again replaces its own rows and ignores them when it looks:
reruns change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.operators.ingest import dedup_earliest

_BITS = 32_768  # bits of one stored bitmap


@dataclass
class SeenIds:
    """The index under ``path``. Sizes are fixed when it is made: ``buckets``, and ``segments`` bitmaps a bucket
    (about ten bits an id keep the filters' error near one in a hundred with ``hashes`` = 7)."""

    spark: SparkSession
    path: str
    buckets: int = 256
    segments: int = 8
    hashes: int = 7

    def _bucket(self, id_col: Column) -> Column:
        return F.pmod(F.xxhash64(id_col, F.lit("bucket")), F.lit(self.buckets)).cast("int")

    def _bits(self, id_col: Column) -> Column:
        places = [F.pmod(F.xxhash64(id_col, F.lit(i)), F.lit(self.segments * _BITS)) for i in range(self.hashes)]
        return F.array_distinct(F.array(*places))

    def _read(self, table: str, schema: str, but: str | None = None) -> DataFrame:
        jvm_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        if not jvm_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path):
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        return found if but is None else found.where(F.col("delivery") != but)

    def ids(self, but: str | None = None) -> DataFrame:
        return self._read("ids", "transaction_id string, bucket int, delivery string", but)

    def filters(self, but: str | None = None) -> DataFrame:
        """(bucket, segment, bitmap) of all deliveries, merged."""
        found = self._read("filters", "segment int, bitmap binary, bucket int, delivery string", but)
        return found.groupBy("bucket", "segment").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def maybe_seen(self, ids: DataFrame, but: str | None = None) -> DataFrame:
        """(transaction_id, bucket) of the distinct ids that the filters cannot rule out."""
        asked = ids.select("transaction_id").where("transaction_id is not null").distinct().withColumn("bucket", self._bucket(F.col("transaction_id")))
        bits = asked.withColumn("_bit", F.explode(self._bits(F.col("transaction_id"))))
        bits = bits.withColumns({"segment": F.floor(F.col("_bit") / _BITS).cast("int"), "_at": (F.col("_bit") % _BITS).cast("int")})
        # bit numbers run from the lowest bit of a byte
        byte = F.conv(F.hex(F.expr("substring(bitmap, _at div 8 + 1, 1)")), 16, 10).cast("int")
        on = F.getbit(byte, F.col("_at") % 8) == 1
        met = bits.join(self.filters(but), ["bucket", "segment"]).where(on)
        needed = asked.select("transaction_id", F.size(self._bits(F.col("transaction_id"))).alias("_need"))
        hits = met.groupBy("transaction_id", "bucket").agg(F.count(F.lit(1)).alias("_on"))
        return hits.join(needed, "transaction_id").where(F.col("_on") == F.col("_need")).select("transaction_id", "bucket")

    def seen(self, ids: DataFrame, but: str | None = None) -> tuple[DataFrame, list[int]]:
        """The ids that the index holds, and the buckets that were read for it."""
        from txnguard.session import checkpoint_root

        checkpoint_root(self.spark)
        maybe = self.maybe_seen(ids, but).checkpoint(eager=True)
        met = sorted(r["bucket"] for r in maybe.select("bucket").distinct().collect())  # numbers, as many as buckets at most
        index = self.ids(but).where(F.col("bucket").isin(met) if met else F.lit(False))
        return maybe.join(index.select("transaction_id", "bucket").distinct(), ["transaction_id", "bucket"], "left_semi").select("transaction_id"), met

    def add(self, ids: DataFrame, delivery: str) -> None:
        """Write a delivery's ids and filter bits; both replace what the same delivery wrote before."""
        own = ids.select("transaction_id").where("transaction_id is not null").distinct().withColumns({"bucket": self._bucket(F.col("transaction_id")), "delivery": F.lit(delivery)})
        bits = own.withColumn("_bit", F.explode(self._bits(F.col("transaction_id"))))
        maps = bits.groupBy("bucket", "delivery", F.floor(F.col("_bit") / _BITS).cast("int").alias("segment")).agg(F.bitmap_construct_agg((F.col("_bit") % _BITS)).alias("bitmap"))
        for table, rows in (("ids", own), ("filters", maps)):
            # partitioned by delivery first, so a rerun overwrites its own rows alone
            rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery", "bucket").parquet(f"{self.path}/{table}")


def dedup_delivery(rows: DataFrame, index: SeenIds, delivery: str) -> tuple[DataFrame, list[int]]:
    """The rows of a delivery whose ids were not seen before, each id once (its earliest row), and the buckets read.

    Rows without an id all stay. The new ids are in the index afterwards.
    """
    from txnguard.session import checkpoint_root

    seen, met = index.seen(rows, but=delivery)
    checkpoint_root(rows.sparkSession)
    fresh = dedup_earliest(rows.join(seen, "transaction_id", "left_anti").select(*rows.columns)).checkpoint(eager=True)
    index.add(fresh, delivery)
    return fresh, met
