"""Parsing, cleaning, de-duplication, messages, contracts."""

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tickloom import schemas
from tickloom.functions import iso_offset_string, market_is_open, parse_iso
from tickloom.operators import clean, dedup, message, parse

PAYLOAD = {
    "ticker": "ZZTA.JK",
    "sector": "Healthcare",
    "timestamp": "2024-01-30T14:05:00+07:00",
    "fetch_ts": "2024-01-30T14:05:42+07:00",
    "open": 512.5,
    "high": 530.0,
    "low": 508.25,
    "close": 521.0,
    "volume": 48200,
}
SAMPLE = json.dumps(PAYLOAD)


@pytest.fixture
def messages(spark):
    def make(payloads):
        rows = [(p, "ticks", 0, i) for i, p in enumerate(payloads)]
        return spark.createDataFrame(rows, "value STRING, topic STRING, partition INT, offset BIGINT")

    return make


def test_record_schema():
    assert schemas.TICK_JSON_V1.names == list(PAYLOAD)
    kinds = [f.dataType for f in schemas.TICK_JSON_V1.fields]
    assert kinds == [T.StringType()] * 4 + [T.DoubleType()] * 4 + [T.LongType()]


def test_sample_payload(messages):
    row = parse.usable_records(parse.parse_messages(messages([SAMPLE]))).first()
    assert {name: row[name] for name in PAYLOAD} == PAYLOAD
    assert not row.partially_corrupt


def changed(**fields):
    return json.dumps({**PAYLOAD, **fields})


@pytest.mark.parametrize(
    "payload, reason, partial",
    [
        ('{"ticker": "ZZTA.JK", "volu', "malformed", False),
        ("", "malformed", False),
        ("   ", "malformed", False),
        (None, "malformed", False),
        ("[]", "malformed", False),
        ("null", "malformed", False),
        ("5", "malformed", False),
        (SAMPLE[:20], "malformed", False),
        ("{}", None, False),
        (changed(bid=1.5), None, False),
        (changed(open="abc"), None, True),
        (changed(timestamp="yesterday"), "no_event_time", False),
        (changed(timestamp=None), "no_event_time", False),
        (changed(ticker=None, timestamp=None), None, False),
    ],
)
def test_parse_matrix(messages, payload, reason, partial):
    row = parse.parse_messages(messages([payload])).first()
    assert (row.reject_reason, row.partially_corrupt) == (reason, partial)


def test_bad_field_is_null_and_the_rest_stays(messages):
    text = SAMPLE.replace("512.5", "NaN").replace("48200", "1.5")
    row = clean.clean_ticks(parse.usable_records(parse.parse_messages(messages([text])))).first()
    assert row.open is None and row.volume is None and row.close == 521.0


def test_dead_letter_layout(messages):
    parsed = parse.parse_messages(messages([SAMPLE, "{broken"]))
    letters = parse.as_dead_letters(parse.malformed_messages(parsed)).collect()
    assert [json.loads(r.value) for r in letters] == [
        {"json_str": "{broken", "topic": "ticks", "partition": 0, "offset": 1}
    ]


def test_parser_runs_once(messages):
    parsed = parse.usable_records(parse.parse_messages(messages([SAMPLE]))).select("ticker", "close")
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_nan_becomes_null(spark):
    nan = float("nan")
    df = spark.createDataFrame([("T", nan, nan, nan, nan, 100)], "ticker STRING, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT")
    row = clean.nan_to_null(df).first()
    assert (row.open, row.high, row.low, row.close, row.volume) == (None, None, None, None, 100)


def test_missing_keys_are_dropped(spark):
    df = spark.createDataFrame([(None, "Energy"), ("", "Energy"), ("ZZTB.JK", "Energy")], "ticker STRING, sector STRING")
    assert [r.ticker for r in clean.drop_bad_keys(df).collect()] == ["ZZTB.JK"]


def test_iso_times(spark):
    df = spark.createDataFrame([("2026-05-21T15:47:00+07:00",), ("not-a-timestamp",)], "s STRING")
    rows = df.select(F.date_format(parse_iso(F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    assert [r.t for r in rows] == ["2026-05-21 08:47:00", None]


def test_iso_text_drops_fractions_and_uses_market_offset(spark):
    df = spark.sql("SELECT TIMESTAMP '2026-05-21 02:30:00.123456Z' AS t")
    assert df.select(iso_offset_string(F.col("t")).alias("s")).first().s == "2026-05-21T09:30:00+07:00"


def test_market_hours(spark):
    times = {
        "2024-01-29 01:59:00": False,
        "2024-01-29 02:00:00": True,
        "2024-01-29 07:59:00": True,
        "2024-01-29 08:00:00": False,
        "2024-01-27 03:00:00": False,
        "2024-01-28 20:00:00": False,
    }
    df = spark.createDataFrame([(t,) for t in times], "t STRING")
    got = df.select("t", market_is_open(F.col("t").cast("timestamp")).alias("open")).collect()
    assert {r.t: r.open for r in got} == times


def test_messages_keep_nulls_and_carry_headers(spark):
    df = spark.sql(
        "SELECT 'T.JK' AS ticker, 'Energy' AS sector, TIMESTAMP '2026-05-21 02:30:00Z' AS timestamp,"
        " TIMESTAMP '2026-05-21 02:30:05Z' AS fetch_ts, double('NaN') AS open, 1.0D AS high,"
        " CAST(NULL AS DOUBLE) AS low, 2.5D AS close, CAST(NULL AS BIGINT) AS volume"
    )
    row = message.to_messages(df).first()
    assert json.loads(row.value) == {
        "ticker": "T.JK",
        "sector": "Energy",
        "timestamp": "2026-05-21T09:30:00+07:00",
        "fetch_ts": "2026-05-21T09:30:05+07:00",
        "open": None,
        "high": 1.0,
        "low": None,
        "close": 2.5,
        "volume": None,
    }
    assert [(h.key, bytes(h.value)) for h in row.headers] == [("schema_name", b"stock_tick"), ("schema_version", b"1")]


def test_messages_round_trip(messages):
    ticks = clean.clean_ticks(parse.usable_records(parse.parse_messages(messages([SAMPLE]))))
    assert json.loads(message.to_messages(ticks).first().value) == PAYLOAD


def test_versions_are_routed_by_header(spark):
    v2 = T.StructType([*schemas.TICK_JSON_V1.fields, T.StructField("bid", T.DoubleType())])
    rows = [
        (SAMPLE, [("schema_name", b"stock_tick"), ("schema_version", b"1")]),
        (changed(bid=1.5), [("schema_name", b"stock_tick"), ("schema_version", b"2")]),
        (SAMPLE, []),
        (SAMPLE, [("schema_name", b"other")]),
    ]
    df = spark.createDataFrame(rows, "value STRING, headers ARRAY<STRUCT<key: STRING, value: BINARY>>")
    routed = parse.route_by_version(df, {"1": schemas.TICK_JSON_V1, "2": v2})
    assert routed["1"].count() == 2
    assert [r.bid for r in routed["2"].collect()] == [1.5]
    assert [r.reject_reason for r in routed["unknown_version"].collect()] == ["unknown_version"]
    assert sum(frame.count() for frame in routed.values()) == len(rows)
    merged = schemas.union_versions(routed["1"], routed["2"])
    assert merged.count() == 3 and "bid" in merged.columns


def test_every_message_is_parsed_by_its_own_version(spark):
    v2 = T.StructType([*schemas.TICK_JSON_V1.fields, T.StructField("bid", T.DoubleType())])
    header = lambda v: [("schema_version", v.encode())]
    rows = [(changed(bid=1.5), header("1"), 0), (changed(bid=1.5), header("2"), 1), (SAMPLE, header("2"), 2), (changed(bid=2.5), header("7"), 3), ("{", header("2"), 4), ("{", header("7"), 5), (None, None, 6)]
    df = spark.createDataFrame(rows, "value STRING, headers ARRAY<STRUCT<key: STRING, value: BINARY>>, offset BIGINT")
    got = {r.offset: (r.schema_version, r.bid, r.ticker, r.reject_reason) for r in parse.parse_by_version(df, {"1": schemas.TICK_JSON_V1, "2": v2}).collect()}
    assert got == {
        0: ("1", None, "ZZTA.JK", None), 1: ("2", 1.5, "ZZTA.JK", None), 2: ("2", None, "ZZTA.JK", None),
        3: ("7", None, None, "unknown_version"), 4: ("2", None, None, "malformed"), 5: ("7", None, None, "unknown_version"),
        6: ("1", None, None, "malformed"),
    }
    retyped = T.StructType([T.StructField("volume", T.StringType())])
    with pytest.raises(ValueError, match="volume"):
        parse.parse_by_version(df, {"1": schemas.TICK_JSON_V1, "2": retyped})


def test_files_of_several_versions_read_as_one(spark, tmp_path):
    v2 = T.StructType([*schemas.TICK.fields, T.StructField("bid", T.DoubleType())])
    spark.createDataFrame([("A.JK",)], "ticker STRING").write.parquet(str(tmp_path / "v1"))
    spark.createDataFrame([("B.JK", 1.5)], "ticker STRING, bid DOUBLE").write.parquet(str(tmp_path / "v2"))
    both = schemas.read_versions(spark, {str(tmp_path / "v1"): schemas.TICK, str(tmp_path / "v2"): v2}, v2)
    assert both.columns == v2.names
    assert {(r.ticker, r.bid) for r in both.collect()} == {("A.JK", None), ("B.JK", 1.5)}


def test_contract_rules():
    v1 = schemas.TICK_JSON_V1
    added = T.StructType([*v1.fields, T.StructField("bid", T.DoubleType())])
    required = T.StructType([*v1.fields, T.StructField("bid", T.DoubleType(), False)])
    removed = T.StructType(v1.fields[:-1])
    retyped = T.StructType([*v1.fields[:-1], T.StructField("volume", T.StringType())])
    assert schemas.is_compatible(v1, v1) and schemas.is_compatible(v1, added)
    assert schemas.contract_changes(v1, removed) == [("volume", "removed", False)]
    assert schemas.contract_changes(v1, retyped) == [("volume", "retyped", False)]
    assert not schemas.is_compatible(v1, required)


def test_conform_fills_missing_columns(spark):
    df = schemas.conform(spark.sql("SELECT 'A' AS ticker, 1 AS volume"), schemas.TICK_JSON_V1)
    row = df.first()
    assert [(n, t) for n, t in df.dtypes] == [(f.name, f.dataType.simpleString()) for f in schemas.TICK_JSON_V1.fields]
    assert (row.ticker, row.volume, row.open) == ("A", 1, None)


def test_field_drift(messages):
    frame = messages([SAMPLE, changed(bid=1), json.dumps({k: v for k, v in PAYLOAD.items() if k != "low"}), "{broken"])
    got = {(r.field, r.drift): r.records for r in parse.field_drift(frame).collect()}
    assert got == {("bid", "unknown"): 1, ("low", "missing"): 1}


def test_first_per_key(spark):
    rows = [("A", 1, 2, "late"), ("A", 1, 1, "early"), ("A", 2, 9, "other")]
    df = spark.createDataFrame(rows, "ticker STRING, timestamp INT, fetch_ts INT, v STRING")
    kept = dedup.first_per_key(df, ["ticker", "timestamp"], ["fetch_ts"])
    assert sorted(r.v for r in kept.collect()) == ["early", "other"]
    assert sorted(dedup.first_per_key(kept, ["ticker", "timestamp"], ["fetch_ts"]).collect()) == sorted(kept.collect())


def rising(rows, known=None):
    """The feed's rule, row by row."""
    marks, kept = dict(known or {}), []
    for ticker, arrival, time in sorted(rows, key=lambda r: r[1]):
        if ticker not in marks or time > marks[ticker]:
            marks[ticker] = time
            kept.append((ticker, arrival, time))
    return sorted(kept)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(st.sampled_from("AAAAB"), st.integers(0, 40)), min_size=1, max_size=60),
    levels=st.integers(0, 3),
)
def test_high_water_matches_row_by_row(spark, rows, levels):
    numbered = [(ticker, i, time) for i, (ticker, time) in enumerate(rows)]
    df = spark.createDataFrame(numbered, "ticker STRING, arrival BIGINT, time INT")
    got = dedup.rising_only(df, "ticker", "arrival", "time", bits=2, levels=levels)
    assert sorted(tuple(r[c] for c in ("ticker", "arrival", "time")) for r in got.collect()) == rising(numbered)


def test_high_water_continues_from_known_marks(spark):
    rows = [("A", 0, 5), ("A", 1, 7), ("B", 2, 1), ("A", 3, 6)]
    df = spark.createDataFrame(rows, "ticker STRING, arrival BIGINT, time INT")
    known = spark.createDataFrame([("A", 5)], "ticker STRING, high_water INT")
    got = dedup.rising_only(df, "ticker", "arrival", "time", known)
    assert sorted(tuple(r[c] for c in ("ticker", "arrival", "time")) for r in got.collect()) == rising(rows, {"A": 5})


