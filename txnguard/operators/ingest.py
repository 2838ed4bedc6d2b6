"""Bronze and silver transforms (R3/R4 bodies) and silver hygiene.

All of them are stateless projections/filters except deduplication, so they
run map-only over the input and work on streams as well as tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.functions.columns import event_time
from txnguard.schemas import (
    EVENT_COLS,
    EVENT_DATE,
    EVENT_SCHEMA,
    LOCATION_DOMAIN,
    MERCHANT_DOMAIN,
    REQUIRED_FIELDS,
    TXN_COLS,
)

CORRUPT_COL = "_corrupt_record"


# --- bronze --------------------------------------------------------------------


def to_bronze(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw record → (value string, ingestion_time timestamp).

    ``value`` is decoded to UTF-8 text as-is (binary Kafka values and text
    lines alike); ``current_timestamp`` is constant within a micro-batch.
    """
    return raw.select(
        F.col(value_col).cast("string").alias("value"),
        F.current_timestamp().alias("ingestion_time"),
    )


def to_wire_json(txns: DataFrame, time_col: str = "ingestion_time") -> DataFrame:
    """Serialise transactions to the producer's wire format (bronze layout).

    The inverse of ``to_silver``: the 8 event fields as one JSON object per
    row in ``value``; the ingestion time is carried over, not re-stamped.
    """
    return txns.select(
        F.to_json(F.struct(*[F.col(c) for c in EVENT_COLS])).alias("value"),
        F.col(time_col).alias("ingestion_time"),
    )


# --- silver --------------------------------------------------------------------


def parse_events(bronze: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """JSON text → ``data`` struct (PERMISSIVE), keeping ingestion_time."""
    return bronze.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("ingestion_time"),
    )


def parse_flat(json_text, schema: T.StructType, options: dict | None = None):
    """Parse + flatten as one generator: ``inline(array(from_json(..)))``.

    Same rows as ``select(from_json(..).alias("data")).select("data.*")``
    (one row per input, all NULL for NULL/bad text), but predicates on the
    parsed fields stay above the generator. With the plain struct form,
    Catalyst pushes such filters below the projection and inlines
    ``from_json`` into every field reference, parsing each row once per
    referenced field.
    """
    return F.inline(F.array(F.from_json(json_text, schema, options or {})))


def to_silver(bronze: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """R4 body: parse + flatten (P3/P4). Unparseable rows become all-NULL rows
    and are kept, exactly like the reference; see ``split_valid`` to reject.
    """
    return bronze.select(parse_flat(F.col("value").cast("string"), schema), F.col("ingestion_time"))


def to_silver_checked(bronze: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Parse with ``_corrupt_record`` (non-JSON and type mismatches) and a
    ``_reject_reason`` column naming the first failed check (NULL = valid).
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    parsed = bronze.select(
        parse_flat(F.col("value").cast("string"), with_corrupt, opts),
        F.col("value").cast("string").alias("_raw"),
        F.col("ingestion_time"),
    )
    return parsed.withColumn("_reject_reason", reject_reason(REQUIRED_FIELDS))


def reject_reason(required: tuple[str, ...] = REQUIRED_FIELDS) -> Column:
    """First failed check, or NULL. Order: empty input, malformed JSON,
    missing/mistyped required field, unparseable event time, negative amount."""
    checks: list[tuple[Column, str]] = [
        (F.col("_raw").isNull() | (F.trim(F.col("_raw")) == ""), "empty"),
        (F.col(CORRUPT_COL).isNotNull(), "malformed_json"),
    ]
    for c in required:
        checks.append((F.col(c).isNull(), f"missing_{c}"))
    checks.append((event_time("transaction_time").isNull(), "bad_transaction_time"))
    checks.append((F.col("transaction_amount") < 0, "negative_amount"))
    expr = F.lit(None).cast("string")
    for cond, name in reversed(checks):
        expr = F.when(cond, F.lit(name)).otherwise(expr)
    return expr


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid silver rows, rejects with reason and raw text).

    Both sides are filters over the same parsed input; in a stream write
    them from one ``foreachBatch`` on a persisted batch so the parse runs
    once.
    """
    valid = checked.filter(F.col("_reject_reason").isNull()).select(*TXN_COLS)
    rejects = checked.filter(F.col("_reject_reason").isNotNull()).select(
        F.col("_raw").alias("value"), "ingestion_time", F.col("_reject_reason").alias("reject_reason")
    )
    return valid, rejects


def dedup_earliest(silver: DataFrame, key: str = "transaction_id") -> DataFrame:
    """D9 (batch): keep the earliest ingestion of each ``transaction_id``.

    An aggregate, not a window: ``min_by`` over the key runs partial
    aggregation map-side, so a transaction delivered a million times is
    collapsed before the shuffle instead of sorted inside one task. Ties on
    ingestion time break on the full row text, deterministically. Rows without
    a key are not copies of each other: they all pass through.
    """
    others = [c for c in TXN_COLS if c != key]
    order = F.struct(F.col("ingestion_time"), *[F.col(c).cast("string") for c in others])
    row = F.struct(*[F.col(c) for c in others])
    picked = silver.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(row, order).alias("_r"))
    kept = picked.select(key, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*TXN_COLS)
    return kept.unionByName(silver.filter(F.col(key).isNull()).select(*TXN_COLS))


def dedup_stream(silver: DataFrame, key: str = "transaction_id", delay: str = "10 minutes") -> DataFrame:
    """D9 (stream): drop repeats of a key seen within the watermark delay.

    State per key lives until the watermark passes its event time + delay.
    On a batch DataFrame this is ``dedup_earliest`` (whole input known).
    """
    if not silver.isStreaming:
        return dedup_earliest(silver, key)
    return (
        silver.withColumn("_et", event_time("transaction_time"))
        .withWatermark("_et", delay)
        .dropDuplicatesWithinWatermark([key])
        .drop("_et")
    )


def normalize(silver: DataFrame) -> DataFrame:
    """Trim text, lower-case ids, title-case known locations, round the
    amount to cents, canonical ISO time text; flags for out-of-domain values.
    """
    loc_map = F.create_map(*[x for v in LOCATION_DOMAIN for x in (F.lit(v.lower()), F.lit(v))])
    loc_key = F.lower(F.trim(F.col("location")))
    et = event_time(F.trim(F.col("transaction_time")))
    return silver.select(
        F.trim(F.col("transaction_id")).alias("transaction_id"),
        F.lower(F.trim(F.col("user_id"))).alias("user_id"),
        F.lower(F.trim(F.col("merchant_id"))).alias("merchant_id"),
        F.round(F.col("transaction_amount"), 2).alias("transaction_amount"),
        F.coalesce(F.date_format(et, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.col("transaction_time")).alias(
            "transaction_time"
        ),
        F.lower(F.trim(F.col("device_id"))).alias("device_id"),
        F.coalesce(loc_map[loc_key], F.trim(F.col("location"))).alias("location"),
        F.col("is_international"),
        F.col("ingestion_time"),
        F.lower(F.trim(F.col("merchant_id"))).isin(MERCHANT_DOMAIN).alias("merchant_known"),
        loc_key.isin([v.lower() for v in LOCATION_DOMAIN]).alias("location_known"),
    )


def with_event_date(df: DataFrame, time_col: str = "transaction_time") -> DataFrame:
    """Partition column for lake tables: the event's UTC date (NULL time →
    the ingestion date, so unparseable rows still land in a partition)."""
    return df.withColumn(
        EVENT_DATE,
        F.coalesce(F.to_date(event_time(time_col)), F.to_date(F.col("ingestion_time"))),
    )

