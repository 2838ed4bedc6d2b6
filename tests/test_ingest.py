"""Bronze/silver transforms and silver hygiene."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import silver_df, txn
from txnguard.operators import ingest as I
from txnguard.schemas import EVENT_COLS, TXN_COLS

VALID = (
    '{"transaction_id":"t1","user_id":"u1","merchant_id":"amazon","transaction_amount":25000.5,'
    '"transaction_time":"2024-01-01T10:00:00","device_id":"device_1","location":"India",'
    '"is_international":true}'
)
T0 = dt.datetime(2024, 1, 1, 10, 0, 5)


def _bronze(spark, values):
    return spark.createDataFrame([(v, T0) for v in values], "value string, ingestion_time timestamp")


def test_to_bronze_decodes_bytes_and_stamps_time(spark):
    raw = spark.createDataFrame([(bytearray(b'{"a":1}'),)], "value binary")
    out = I.to_bronze(raw).first()
    assert out.value == '{"a":1}' and out.ingestion_time is not None


def test_valid_event_parses_to_typed_row(spark):
    r = I.to_silver(_bronze(spark, [VALID])).first()
    assert r.transaction_amount == 25000.5 and r.is_international is True
    assert r.ingestion_time == T0


def test_bad_inputs_become_all_null_rows_and_are_kept(spark):
    # Test key, non-JSON, NULL, empty, array → one all-NULL row each
    values = ['{"testing_key":"testing_pair"}', "not json", None, "",
              '[{"transaction_id":"a"},{"transaction_id":"b"}]']
    out = I.to_silver(_bronze(spark, values))
    assert out.count() == len(values)
    assert out.filter(F.coalesce(*[F.col(c).cast("string") for c in EVENT_COLS]).isNotNull()).count() == 0


def test_field_coercion(spark):
    # G4
    values = [
        '{"transaction_id":"q","transaction_amount":"25000.5"}',
        '{"transaction_id":"b","is_international":"true"}',
        '{"transaction_id":"d","device_id":["device_10","device_11"]}',
        '{"transaction_id":"n","user_id":5}',
    ]
    rows = {r.transaction_id: r for r in I.to_silver(_bronze(spark, values)).collect()}
    assert rows["q"].transaction_amount is None
    assert rows["b"].is_international is None
    assert rows["d"].device_id == '["device_10","device_11"]'
    assert rows["n"].user_id == "5"


def test_corrupt_record_and_reasons(spark):
    values = [VALID, '{"testing_key":"testing_pair"}', "not json", None, "",
              VALID.replace("2024-01-01T10:00:00", "yesterday"),
              VALID.replace("25000.5", "-3.0")]
    checked = I.to_silver_checked(_bronze(spark, values))
    reasons = [r._reject_reason for r in checked.collect()]
    assert reasons == [None, "missing_transaction_id", "malformed_json", "empty", "empty",
                       "bad_transaction_time", "negative_amount"]
    # _corrupt_record: non-JSON only, not valid JSON with missing fields
    corrupt = [r._corrupt_record for r in checked.collect()]
    assert corrupt[1] is None and corrupt[2] == "not json"


def test_split_valid(spark):
    valid, rejects = I.split_valid(I.to_silver_checked(_bronze(spark, [VALID, "junk"])))
    assert valid.columns == TXN_COLS and valid.count() == 1
    r = rejects.first()
    assert (r.value, r.reject_reason) == ("junk", "malformed_json")


def test_filter_on_parsed_field_parses_once(spark):
    # the parse is a generator, so a filter on a parsed field stays above it
    df = I.to_silver(_bronze(spark, [VALID])).filter(F.col("transaction_amount") > 20000)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_wire_json_round_trip(spark):
    rows = [txn("a", amount=1231.0000000000002, intl=True), txn("b", device='["x"]')]
    silver = silver_df(spark, rows)
    back = I.to_silver(I.to_wire_json(silver))
    assert back.exceptAll(silver).count() == 0 and silver.exceptAll(back).count() == 0


def test_dedup_keeps_earliest_delivery(spark):
    late = dt.datetime(2024, 1, 1, 11, 0, 0)
    rows = [txn("a", merchant="late", ingested=late), txn("a", merchant="early"), txn("b")]
    out = {r.transaction_id: r for r in I.dedup_earliest(silver_df(spark, rows)).collect()}
    assert len(out) == 2 and out["a"].merchant_id == "early"


def test_dedup_stream_form_in_batch(spark):
    rows = [txn("a"), txn("a", ingested=dt.datetime(2024, 1, 1, 10, 1)), txn("b")]
    assert I.dedup_stream(silver_df(spark, rows)).count() == 2


def test_normalize(spark):
    rows = [txn(" t1 ", user=" User_9 ", merchant=" Amazon", location=" usa ", amount=10.004,
                time=" 2024-01-01T10:00:00 "),
            txn("t2", merchant="ebay", location="Mars")]
    out = {r.transaction_id: r for r in I.normalize(silver_df(spark, rows)).collect()}
    a = out["t1"]
    assert (a.user_id, a.merchant_id, a.location, a.transaction_amount) == ("user_9", "amazon", "USA", 10.0)
    assert a.transaction_time == "2024-01-01T10:00:00.000000"
    assert a.merchant_known and a.location_known
    b = out["t2"]
    assert not b.merchant_known and not b.location_known and b.location == "Mars"


def test_dedup_lets_rows_without_an_id_through(spark):
    rows = [txn(None), txn(None, user="u2"), txn("a"), txn("a", ingested="2024-01-01 11:00:00")]
    assert I.dedup_earliest(silver_df(spark, rows)).count() == 3
