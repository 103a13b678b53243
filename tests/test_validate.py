"""Which records are accepted, and why the others are not."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.bronze import bronze
from tidemark.operators.validate import quarantined, valid_events, validate
from tidemark.sources.raw import from_text, read_raw

GOOD = {
    "event_id": "1", "event_type": "search", "event_ts": "2026-05-18T10:01:00",
    "user_id": 101, "country": "US", "query": "x",
}
MISSING = object()


def record(**changes):
    fields = {k: v for k, v in {**GOOD, **changes}.items() if v is not MISSING}
    return json.dumps(fields)


def judge(spark, text):
    frame = spark.createDataFrame([(text,)], "value string")
    return validate(from_text(frame)).first()


@pytest.mark.parametrize(
    "value, expected",
    [(101, 101), ("101", 101), (" 7 ", 7), (1.0, 1), ("1.0", 1), (True, 1), (-3, -3), ("+4", 4)],
)
def test_user_ids_accepted(spark, value, expected):
    row = judge(spark, record(user_id=value))
    assert (row.verdict, row.user_id) == ("valid", expected)


@pytest.mark.parametrize("value", [1.5, "1.5", "abc", "", "1e3", None, MISSING, [1], {"a": 1}, 2**70])
def test_user_ids_rejected(spark, value):
    assert judge(spark, record(user_id=value)).reason == "bad_user_id"


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({"event_id": 5}, "bad_event_id"),
        ({"event_id": MISSING}, "bad_event_id"),
        ({"event_type": None}, "bad_event_type"),
        ({"event_ts": 17}, "bad_event_ts"),
        ({"country": MISSING}, "bad_country"),
        ({"event_ts": "yesterday"}, "unparsable_event_ts"),
        ({"event_ts": ""}, "unparsable_event_ts"),
        ({"event_id": "", "country": ""}, None),
        ({"context": {"a": [1, 2]}}, None),
        ({"event_type": "anything"}, None),
    ],
)
def test_other_fields(spark, changes, reason):
    assert judge(spark, record(**changes)).reason == reason


@pytest.mark.parametrize("text", ['{"event_id": "1", ', "nonsense", ""])
def test_broken_json(spark, text):
    row = judge(spark, text)
    assert (row.reason, row.raw_text) == ("corrupt_json", text)


def test_json_that_is_no_object(spark):
    assert judge(spark, "[1, 2]").reason == "bad_event_id"


def test_every_record_goes_one_way(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([record(), record(user_id="x"), '{"event_id":']))
    judged = validate(read_raw(spark, str(tmp_path)))
    assert valid_events(judged).count() == 1
    assert {r.reason for r in quarantined(judged).collect()} == {"bad_user_id", "corrupt_json"}


def test_bronze_row(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        "\n".join([record(extra={"deep": 1}), record(event_type="x/../y", user_id="x")])
    )
    at = F.lit("2026-05-19 00:00:00").cast("timestamp_ntz")
    good, bad = bronze(read_raw(spark, str(tmp_path)), at).orderBy(F.desc("verdict")).collect()
    assert (good.event_id, good.user_id, good.query, good.page) == ("1", 101, "x", None)
    assert str(good.event_date) == "2026-05-18"
    assert str(good.ingested_processing_ts) == "2026-05-19 00:00:00"
    assert good.source_file.endswith("a.json")
    assert json.loads(good.payload.toJson())["extra"] == {"deep": 1}
    # A rejected record names no partition but keeps its payload.
    assert (bad.event_type, bad.event_date, bad.reason) == (None, None, "bad_user_id")
    assert json.loads(bad.payload.toJson())["event_type"] == "x/../y"


def test_times_do_not_depend_on_the_session_zone(spark):
    texts = {
        "2024-01-01T23:30:00": "2024-01-01 23:30:00",
        "2024-01-01 23:30:00.25": "2024-01-01 23:30:00.250000",
        "2024-01-01T23:30:00+02:00": "2024-01-01 21:30:00",
        "2024-01-01T23:30:00Z": "2024-01-01 23:30:00",
        "2024-01-05": "2024-01-05 00:00:00",
    }
    from tidemark.functions import utc_timestamp

    frame = spark.createDataFrame([(t,) for t in texts], "s string")
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found = {r.s: str(r.t) for r in frame.select("s", utc_timestamp(F.col("s")).alias("t")).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert found == texts


@pytest.mark.parametrize(
    "sent,want",
    [("101", 101), ('" 7 "', 7), ("1.0", 1), ('"1.0"', 1), ("true", 1), ("1e2", 100), ("9007199254740993", 9007199254740993),
     ("1.0000001", None), ('"1.0000001"', None), ("7.00000000004", None), ("1.5e0", None), ('"1e2"', None), ("null", None),
     ("9223372036854775808", None)],
)
def test_user_ids_are_not_rounded(spark, sent, want):
    from tidemark.functions.parse import whole_number

    row = spark.createDataFrame([('{"u": %s}' % sent,)], "v string").select(F.try_parse_json("v").alias("p"))
    assert row.select(whole_number(F.col("p"), "u")).first()[0] == want
