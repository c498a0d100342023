"""Payload ingest (G11, G12), topics, read views and city checks (G16, G20)."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from helpers import ts
from shoreline import schemas
from shoreline.operators import views
from shoreline.session import shared_dir
from shoreline.sources import payloads, topics
from shoreline.sources.cities import city_dimension, read_cities
from shoreline.streaming import apps


def _hourly(spark, times, temps, pps, run=0):
    return spark.createDataFrame([("A", run, (times, temps, pps))], schemas.PAYLOAD_HOURLY)


def test_g11_zip_stops_at_shortest_array(spark):
    p = _hourly(spark, ["2024-01-05T07:00", "2024-01-05T08:00", "2024-01-05T09:00"],
                [21.0, 22.0], [10.0, 11.0, 12.0])
    rows = payloads.ingest_hourly(p).orderBy("hora").collect()
    assert [(r["hora"], r["temperatura"], r["pp"]) for r in rows] == \
        [(ts(7), 21.0, 10.0), (ts(8), 22.0, 11.0)]


def test_g12_horizon_keeps_current_hour(spark):
    p = _hourly(spark, ["2024-01-05T07:00", "2024-01-05T08:00"], [21.0, 22.0], [1.0, 2.0])
    rows = payloads.ingest_hourly(p, now="2024-01-05 08:45:00").collect()
    assert [r["hora"] for r in rows] == [ts(8)]


def test_later_run_gets_higher_offsets(spark):
    p0 = _hourly(spark, ["2024-01-05T07:00"] * 2, [21.0, 22.0], [1.0, 2.0], run=0)
    p1 = _hourly(spark, ["2024-01-05T07:00"], [30.0], [3.0], run=1)
    rows = payloads.ingest_hourly(p0.unionByName(p1)).orderBy("off").collect()
    assert [r["temperatura"] for r in rows] == [21.0, 22.0, 30.0]


def test_daily_ingest_has_no_horizon(spark):
    p = spark.createDataFrame([("A", 0, (["2024-01-05T06:10"], ["2024-01-05T17:50"]))],
                              schemas.PAYLOAD_DAILY)
    r = payloads.ingest_daily(p).first()
    assert (r["sunrise"], r["sunset"]) == (ts(6, 10), ts(17, 50))


def test_topic_roundtrip_keeps_nulls(spark):
    path = shared_dir(spark, "test-topic")
    df = spark.createDataFrame([(1, "A", "2024-01-05T07:00", None)],
                               "off long, local string, hora string, pp double")
    topics.write_topic(topics.to_records(df, ["local", "hora", "pp"], topic="pp"), path)
    rec = topics.read_topic(spark, path).first()
    assert json.loads(rec["value"]) == {"local": "A", "hora": "2024-01-05T07:00", "pp": None}
    assert rec["key"] == "A" and rec["off"] == 1


def test_g16_hour_view_is_a_one_hour_period(spark):
    df = spark.createDataFrame([("A", ts(9))], "local string, hora timestamp_ntz")
    r = views.hour_periods(df).first()
    assert (r["inicio"], r["fim"]) == (ts(9), ts(10))


def test_g20_unknown_city_rejected(spark):
    df = spark.createDataFrame([("Ubatuba",)], "local string")
    with pytest.raises(views.UnknownCity):
        views.for_city(df, "Nowhere")
    assert views.for_city(df, "Ubatuba").count() == 1


def test_read_models(spark):
    day = spark.createDataFrame(
        [("A", ts(7).date(), True, True, ts(7), ts(8, 59))],
        "local string, dia date, isDay boolean, boaHora boolean, inicio timestamp_ntz, "
        "fim timestamp_ntz")
    r = views.beach_day_view(day).first()
    assert (r["dia"], r["inicio"], r["fim"]) == ("2024-01-05", "2024-01-05T07:00", "2024-01-05T08:59")
    hour = spark.createDataFrame([("A", ts(7), 21.5, 30.0, 1.0, True, False)],
                                 "local string, hora timestamp_ntz, temperatura double, pp double, "
                                 "uv double, isDay boolean, boaHora boolean")
    r = views.beach_hour_view(hour).first()
    assert (r["temperatura"], r["pp"], r["uv"], r["hora"]) == ("21.5", "30.0", "1.0", "2024-01-05T07:00")


def test_week_window(spark):
    df = spark.createDataFrame([(ts(7),), (ts(7, day=ts(0).date().replace(day=12)),)],
                               "inicio timestamp_ntz")
    assert views.week_window(df, "2024-01-05 00:00:00").count() == 1


def test_city_file_and_dimension_agree(spark, tmp_path):
    from shoreline.sources.cities import CITY_COORDINATES
    f = tmp_path / "cities.json"
    f.write_text(json.dumps(CITY_COORDINATES, indent=4))
    a = sorted(tuple(r) for r in read_cities(spark, str(f)).collect())
    b = sorted(tuple(r) for r in city_dimension(spark).collect())
    assert a == b and len(a) == 5


def test_tolerant_numeric_read(spark):
    from pyspark.sql import types as T
    recs = spark.createDataFrame(
        [('{"local":"A","pp":12.5}',), ('{"local":"A","pp":"7"}',), ('{"local":"A","pp":"x"}',),
         ('{"local":"A","pp":null}',)], "value string")
    schema = T.StructType([T.StructField("local", T.StringType()), T.StructField("pp", T.DoubleType())])
    got = [r["pp"] for r in topics.decode(recs, schema, keep=(), tolerant=True).collect()]
    assert got == [12.5, 7.0, 0.0, None]
    strict = [r["pp"] for r in topics.decode(recs, schema, keep=()).collect()]
    assert strict[0] == 12.5 and strict[2] is None


def test_records_without_key_fields_are_rejected(spark):
    recs = spark.createDataFrame(
        [("A", '{"local":"A","hora":"2024-01-05T07:00","pp":1.0}', 1),
         ("A", '{"local":"A","hora":null,"pp":1.0}', 2),          # explicit null: accepted
         ("A", '{"local":"A","pp":1.0}', 3),                      # hora absent: rejected
         ("A", 'not json', 4)],
        "key string, value string, off long")
    ok, bad = topics.split_rejected(recs)
    assert sorted(r["off"] for r in ok.collect()) == [1, 2]
    assert {(r["off"], r["_rejected_reason"]) for r in bad.collect()} == \
        {(3, "missing required field"), (4, "not a JSON object")}


def test_malformed_times_are_null_and_rejected(spark):
    from shoreline.functions import parse_wire
    from shoreline.sources import topics

    texts = ["2024-01-08T09:30", "2024-13-08T09:00", "soon", "2024", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] is not None for r in df.select(parse_wire("t")).collect()] == [True] + [False] * 5
    values = ['{"local":"a","hora":"2024-01-08T09:30"}', '{"local":"a","hora":"soon"}', '{"local":"a","hora":null}', '{"local":"a"}', "x"]
    recs = spark.createDataFrame([(None, "a", v, i) for i, v in enumerate(values)], topics.TOPIC_RECORD)
    ok, bad = topics.split_rejected(recs)
    assert sorted(r.off for r in ok.collect()) == [0, 2]
    assert {r.off: r._rejected_reason for r in bad.collect()} == {
        1: "malformed time", 3: "missing required field", 4: "not a JSON object"}


def test_a_fan_out_keeps_the_topic_of_each_record(spark):
    from shoreline.sources import topics

    recs = spark.createDataFrame([("t1", "a", "{}", 1), ("t2", "a", "{}", 2)], topics.TOPIC_RECORD)
    assert topics.kafka_records(recs).columns == ["topic", "key", "value"]
    assert topics.kafka_records(recs, {"topic": "one"}).columns == ["key", "value"]


def test_week_days_cover_the_whole_window():
    from shoreline.operators.views import week_days

    assert week_days("2024-01-08") == ("2024-01-08", "2024-01-15")
    assert week_days("2024-01-08 00:00:00") == ("2024-01-08", "2024-01-15")
    assert week_days("2024-01-08 12:00") == ("2024-01-08", "2024-01-16")


def test_retention_keeps_the_last_minutes_of_a_topic(spark):
    from shoreline.sources import topics
    df = spark.sql("SELECT 'A' AS local, id AS off, CASE WHEN id < 3 THEN "
                   "timestampadd(MINUTE, -30 * id, TIMESTAMP_NTZ'2024-01-05 10:00:00') END AS ts FROM range(4)")
    kept = topics.retain(topics.to_records(df, ["local"], time="ts"), "2024-01-05 10:00:00", 59)
    assert {r["off"] for r in kept.collect()} == {0, 1}


def test_landed_documents_skip_broken_lines_and_missing_arrays(spark):
    from shoreline import schemas
    from shoreline.session import shared_dir
    from shoreline.sources import payloads
    path = shared_dir(spark, "test-payloads")
    docs = ['{"local":"A","run":0,"hourly":{"time":["2024-01-05T07:00","bad"],"uv_index":[1.5,2.0]}}',
            '{"local":"A","run":1,"hourly":{"time":["2024-01-05T08:00"]}}', '{"local":"A","run":2}', '{broken']
    spark.createDataFrame([(d,) for d in docs], "value string").write.text(path)
    got = payloads.ingest_uv(payloads.read_payloads(spark, path, schemas.PAYLOAD_UV)).orderBy("off").collect()
    assert [(r["off"], r["hora"] is None, r["uv_index"]) for r in got] == [(0, False, 1.5), (1, True, 2.0)]


def test_broken_hour_lists_of_grouped_records(spark):
    from shoreline.plans.wire_queries import grouped_rows
    lists = ['[{"hora":"2024-01-05T09:00"},{"hora":"2024-01-05T08:00"},{"hora":"x"},{"hora":"2024-01-05T09:00"}]',
             "[]", "not json"]
    rows = [('{"local":"A","dia":"2024-01-05","isDay":true,"boaHora":true,"intervalos":%s}'
             % __import__("json").dumps(v),) for v in lists]
    got = grouped_rows(spark.createDataFrame(rows, "value string")).collect()
    assert [None if r["horas"] is None else [h.hour for h in r["horas"]] for r in got] == [[8, 9], [], None]


_T0 = "2024-01-05T10:00"
ODD_VALUES = [
    None, "", "{}", "[]", "null", "5", "not json", '{"local":"A","temperatura":1.0}', '{"hora":"%s"}' % _T0,
    '{"local":"A","hora":"%s","temperatura":1.5}' % _T0, '{"local":null,"hora":"%s"}' % _T0, '{"local":"A","hora":null}',
    '{"local":"A","hora":"soon"}', '{"local":"A","hora":5}', '{"local":"A","hora":{"a":1}}', '[{"local":"A","hora":"%s"}]' % _T0,
    '{"local":"A","hora":"%s","temperatura":NaN}' % _T0, '{"local":"A","hora":"%s","x":-INF}' % _T0,
    '{"local":"A","hora":"%s","temperatura":"NaN"}' % _T0, '{"local":"NaNville","hora":"%s","temperatura":3}' % _T0,
    '{"local":"A","hora":"%s","temperatura":1x}' % _T0, '{"local":"A","hora":"%s","temperatura":tru}' % _T0,
    '{"local":"A","hora":"%s","temperatura":"7"}' % _T0, '{"local":"A","hora":"%s","temperatura":"abc"}' % _T0,
    '{"local":"A","hora":"%s","temperatura":' % _T0, '{"local":"A","hora":"%s"} rest' % _T0,
    '{"local":"a\tb","hora":"%s"}' % _T0, '{"local":"a\tb","hora":"bad"}', "{'local':'A','hora':'%s'}" % _T0,
    '{"local":"\\u0041","h\\u006fra":"%s"}' % _T0, '{"local":"A","hora":"%s","hora":"bad"}' % _T0,
    '{"local":"A","hora":"bad","hora":"%s"}' % _T0, '{"local":"A","hora":"bad","hora":null}']


@pytest.mark.parametrize("tolerant", [False, True])
def test_a_record_is_either_decoded_or_rejected(spark, tolerant):
    schema = T.StructType([T.StructField("local", T.StringType()), T.StructField("hora", T.StringType()),
                           T.StructField("temperatura", T.DoubleType())])
    recs = spark.createDataFrame([("t", "A", v, i) for i, v in enumerate(ODD_VALUES)], topics.TOPIC_RECORD)
    rows = lambda df: {r.off: tuple(map(repr, r)) for r in df.collect()}  # noqa: E731 (NaN equals itself as text)
    for columns in (schema, T.StructType(schema.fields[2:]), T.StructType([T.StructField("hora", T.TimestampNTZType())])):
        ok, bad = topics.split_rejected(recs)
        got = rows(topics.decode_accepted(recs, columns, tolerant=tolerant))
        assert got == rows(topics.decode(ok, columns, tolerant=tolerant))
        rejected = {r.off for r in bad.collect()}
        assert not rejected & set(got) and rejected | set(got) == set(range(len(ODD_VALUES)))


def test_a_sound_record_is_parsed_once(spark, monkeypatch):
    # key lookups stand in the ELSE of a CASE; the parse is a generator's, below the filter
    schema = T.StructType([T.StructField("local", T.StringType()), T.StructField("hora", T.StringType())])
    recs = spark.createDataFrame([], topics.TOPIC_RECORD)
    path = shared_dir(spark, "test-one-parse")
    topics.write_topic(recs, path)
    monkeypatch.setattr(topics, "stream_records", lambda spark, path, *_: topics.read_topic(spark, path))
    plan = apps.topic_stream(spark, path, schema)._jdf.queryExecution().optimizedPlan().toString()
    above, generate = plan.split("Generate", 1)
    assert generate.count("from_json") == 1
    sound, rest = above.split("ELSE (coalesce(", 1)
    assert "Filter CASE WHEN" in sound
    for parse in ("jsonObjectKeys", "get_json_object", "from_json"):
        assert parse not in sound and parse in rest
