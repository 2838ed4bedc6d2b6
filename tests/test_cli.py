"""Command-line apps drive the same runners end to end."""

from __future__ import annotations

from conftest import SF_SMALL
from test_streaming import _json_line, _write_text
from txnguard.__main__ import main
from txnguard.operators import ingest as I
from txnguard.sources.tables import read_transactions


def test_cli_stream_stages_then_batch_consolidation(spark, scratch):
    raw, bronze, silver, gold = (f"{scratch}/{n}" for n in ("raw", "bronze", "silver", "gold"))
    I.to_wire_json(read_transactions(spark, SF_SMALL)).select("value").coalesce(1).write.text(raw)
    _write_text(raw, "zz_flush", [_json_line("flush", "zz", 1.0, "2099-01-01T00:00:00", False)])
    main(["ingest", "--text", raw, "--bronze", bronze, "--checkpoint", f"{scratch}/ck/i", "--once"], spark)
    main(["silver", "--bronze", bronze, "--silver", silver, "--checkpoint", f"{scratch}/ck/s", "--once"], spark)
    main(["gold", "--silver", silver, "--gold", gold, "--checkpoint", f"{scratch}/ck/g", "--once"], spark)
    info = main(["consolidate", "--silver", silver, "--gold", gold], spark)
    assert info["broadcast_windows"] is True
    union = spark.read.parquet(f"{gold}/fraud_union")
    assert union.count() == 93
    # the reference table layouts, plus our event_date partition column
    from pyspark.sql import types as T

    from txnguard.schemas import FRAUD_UNION_COLS, HIGH_AMOUNT_COLS, VELOCITY_COLS

    assert spark.read.parquet(f"{gold}/high_amount_fraud").columns == HIGH_AMOUNT_COLS + ["event_date"]
    vel = spark.read.parquet(f"{gold}/velocity_fraud")
    assert vel.columns == VELOCITY_COLS + ["event_date"]
    assert [f.name for f in vel.schema["window"].dataType.fields] == ["start", "end"]
    assert union.columns == FRAUD_UNION_COLS + ["event_date"]
    assert union.schema["triggered_rules"].dataType == T.ArrayType(T.StringType(), True)


def test_cli_help_lists_commands(capsys):
    import pytest

    with pytest.raises(SystemExit):
        main(["--help"])
    out = capsys.readouterr().out
    for cmd in ("ingest", "silver", "gold", "detect", "hits", "regroup", "consolidate", "lake"):
        assert cmd in out
