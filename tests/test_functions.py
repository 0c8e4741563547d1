import hashlib

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kerbside.functions import clock, labels, lines
from kerbside.functions.pages import (
    content_hash, convert, explode_items, first_item, last_item, next_link, page_schema, parse_items, unreadable_pages,
)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_page_schema_shares_parents():
    assert page_schema(["data.events", "events"], ["last_updated"]) == (
        "struct<last_updated:string,data:struct<events:array<string>>,events:array<string>>"
    )


def test_items_come_from_the_first_path_that_holds_an_array(spark, page):
    bronze = page(
        ("VOI", "EVENTS", '{"data":{"events":[{"a":1},null,{"a":2}]},"events":[{"a":9}]}'),
        ("VOI", "EVENTS", '{"events":[{"a":3}]}'),
        ("VOI", "EVENTS", '{"data":null,"events":[{"a":4}]}'),
        ("VOI", "EVENTS", '{"data":{},"events":[{"a":5}]}'),
        ("VOI", "EVENTS", '{"data":{"events":[]}}'),
        ("VOI", "EVENTS", '{"other":1}'),
        ("VOI", "EVENTS", "{broken"),
        ("VOI", "EVENTS", None),
    )
    paths = ["data.events", "events"]
    got = parse_items(bronze, paths, "struct<a:string>").select("item.a")
    assert rows(got) == [("1",), ("2",), ("3",), ("4",), ("5",)]
    assert rows(unreadable_pages(bronze, paths)) == [("f5",), ("f6",)]


def test_one_bad_element_spoils_only_itself(page):
    bronze = page(("VOI", "TRIPS", '{"trips":[{"a":"x"},"text",7,[1],{"a":{"deep":1}},{"a":"y"}]}'))
    got = [r[0] for r in parse_items(bronze, ["trips"], "struct<a:string>").select("item.a").collect()]
    assert got == ["x", None, None, None, '{"deep":1}', "y"]


def test_document_array_and_root_fields(page):
    array = page(("POPPY", "TRIPS", '[{"a":1},{"a":2}]', "2024-05-01 00:00:00"))
    assert len(rows(explode_items(array, [""], keep=("load_ts",)))) == 2
    rooted = page(("POPPY", "X", '{"last_updated":12,"data":{"bikes":[{"a":1}]}}'))
    got = explode_items(rooted, ["data.bikes"], root=("last_updated",))
    assert rows(got, "last_updated", "item") == [("12", '{"a":1}')]


def test_first_and_last_item(spark):
    full, empty = F.array(F.lit("a"), F.lit("b")), F.array().cast("array<string>")
    assert value(spark, first_item(full)) == "a"
    assert value(spark, last_item(full)) == "b"
    for nothing in (empty, F.lit(None).cast("array<string>")):
        assert value(spark, first_item(nothing)) is None
        assert value(spark, last_item(nothing)) is None


def test_bad_numbers_fail_or_become_null(spark):
    assert value(spark, convert(F.lit("12.5"), "bigint", strict=False)) is None
    with pytest.raises(PySparkException):
        value(spark, convert(F.lit("12.5"), "bigint"))


def test_hash_ignores_key_order_and_space(spark):
    a, b = F.lit('{"a":1,"b":[1,{"x":2,"y":3}]}'), F.lit('{"b": [1, {"y": 3, "x": 2}], "a": 1}')
    assert value(spark, content_hash(a)) == value(spark, content_hash(b))
    assert value(spark, content_hash(a)) != value(spark, content_hash(F.lit('{"a":1,"b":[{"x":2,"y":3},1]}')))
    assert value(spark, content_hash(F.lit("{broken"))) is not None
    assert value(spark, content_hash(F.lit(None).cast("string"))) is None


def test_one_hash_rule_for_all_sizes(spark):
    for size in (10, 20_000_000):  # eight items of the larger size are beyond what a VARIANT value can hold
        text = F.repeat(F.lit("x"), size)
        one = F.concat(F.lit('{"k":"'), text, F.lit('","l":1}'))
        turned = F.concat(F.lit('{"l": 1, "k": "'), text, F.lit('"}'))
        many = lambda item: F.array_join(F.array_repeat(item, 8), ",")
        page = F.concat(F.lit('{"v":1,"data":{"t":2,"items":['), many(one), F.lit("]}}"))
        same = F.concat(F.lit('{"data": {"items": ['), many(turned), F.lit('], "t": 2}, "v": 1}'))
        other = F.concat(F.lit('{"data": {"items": ['), many(turned), F.lit('], "t": 3}, "v": 1}'))
        got = spark.range(1).select(content_hash(page).alias("a"), content_hash(same).alias("b"), content_hash(other).alias("c")).first()
        assert got.a == got.b != got.c


def test_hash_tells_texts_from_numbers(spark):
    bodies = ('{"a":1}', '{"a":"1"}', '{"a":null}', '{"a":[1]}', '{"a":["1"]}', '[1]', '["1"]', "1", '{"a":{"b":1}}', '{"a":{"b":"1"}}')
    assert len({value(spark, content_hash(F.lit(b))) for b in bodies}) == len(bodies)


def test_hash_keeps_kinds_at_every_depth(spark):
    def hashes(*bodies):
        return [r[0] for r in spark.createDataFrame([(b,) for b in bodies], "content string").select(content_hash(F.col("content"))).collect()]

    apart = hashes(
        '{"a":"1","b":2}', '{"a":1,"b":"2"}', '{"x":null,"y":"null"}', '{"x":"null","y":null}', '{"a":true}', '{"a":"true"}', '{"a":1}', '{"a":1.0}',
        '{"a":{"b":{"c":"1","d":2}}}', '{"a":{"b":{"c":1,"d":"2"}}}', '{"a":1} x', "x", "", "[" * 100_000, "[" * 100_001,
    )
    assert len(set(apart)) == len(apart)
    one, turned = hashes('{"d":{"e":{"p":1,"q":2}},"l":[{"a":1,"b":"\\u00e9"}]}', '{ "l": [ {"b":"é", "a":1} ],\n"d":{"e":{"q":2,"p":1}}}')
    assert one == turned == hashlib.md5(b'{"d": {"e": {"p": 1, "q": 2}}, "l": [{"a": 1, "b": "\\u00e9"}]}').hexdigest()


def test_next_link(spark):
    assert value(spark, next_link(F.lit('{"links":{"next":"u"}}'))) == "u"
    for body in ('{"links":{"next":null}}', '{"links":{}}', "[1]"):
        assert value(spark, next_link(F.lit(body))) is None


def test_epoch_units(spark):
    ms = spark.range(1).select(
        clock.ts_millis(F.lit("1713175200123")).cast("string").alias("m"),
        clock.ts_seconds(F.lit("1713175200")).cast("string").alias("s"),
    ).first()
    assert (ms.m, ms.s) == ("2024-04-15 10:00:00.123", "2024-04-15 10:00:00")


@pytest.mark.parametrize(
    "provider, endpoint, kind, start, end",
    [
        ("poppy", "trips/brussels", "days", "2024-05-09 00:00:00", "2024-05-10 00:00:00"),
        ("voi", "events/historical", "event_time", "2024-05-10 08:00:00", "2024-05-10 08:00:00"),
        ("bolt", "status_changes", "event_time", "2024-05-10 08:00:00", "2024-05-10 08:00:00"),
        ("dott", "telemetry", "telemetry_time", "2024-05-10 11:00:00", "2024-05-10 11:00:00"),
        ("bolt", "trips", "end_time", "2024-05-10 08:00:00", "2024-05-10 08:00:00"),
        ("dott", "events", "millis", "2024-05-10 10:34:56", "2024-05-10 11:34:56"),
        ("voi", "vehicles", None, None, None),
    ],
)
def test_request_window(spark, provider, endpoint, kind, start, end):
    w = clock.request_window(F.lit(provider), F.lit(endpoint), F.lit("2024-05-10 12:34:56").cast("timestamp"))
    got = spark.range(1).select(w.alias("w")).select(
        "w.kind", F.col("w.window_start").cast("string"), F.col("w.window_end").cast("string")
    ).first()
    assert tuple(got) == (kind, start, end)


def test_labels(spark):
    got = [value(spark, labels.event_priority(F.lit(e))) for e in ("trip_end", "user_pick_up", "maintenance_drop_off", "ping", None)]
    assert got == [1, 1, 2, 3, 3]
    assert value(spark, labels.plain_scooter(F.lit("scooter_standing"))) == "scooter"
    assert value(spark, labels.plain_scooter(F.lit("car"))) == "car"
    uid = labels.status_uid(F.lit("AbC"), F.lit("2024-05-10 12:34:56.789123").cast("timestamp"))
    assert value(spark, uid) == "abc_20240510_123456789"
    assert value(spark, labels.status_uid(F.lit("a"), F.lit(None).cast("timestamp"))) is None


def pt(lon, lat):
    return lines.point(F.lit(lon).cast("double"), F.lit(lat).cast("double"))


def line(*pairs):
    return F.array(*[pt(*p) for p in pairs])


def pairs(spark, column):
    got = value(spark, column)
    return None if got is None else [(p.lon, p.lat) for p in got]


def test_points_and_lines_need_all_their_parts(spark):
    assert value(spark, pt(None, 1.0)) is None
    assert pairs(spark, lines.straight_line(pt(1.0, 2.0), pt(3.0, 4.0))) == [(1, 2), (3, 4)]
    assert pairs(spark, lines.straight_line(pt(1.0, 2.0), pt(None, 4.0))) is None
    way = line((5.0, 6.0))
    assert pairs(spark, lines.stitch(pt(1.0, 2.0), way, pt(3.0, 4.0))) == [(1, 2), (5, 6), (3, 4)]
    assert pairs(spark, lines.stitch(pt(1.0, 2.0), way, pt(None, None))) is None
    assert pairs(spark, lines.stitch(pt(1.0, 2.0), F.lit(None).cast(lines.LINE_TYPE), pt(3.0, 4.0))) is None


@pytest.mark.parametrize(
    "before, after",
    [
        ([(1, 1), (1, 1), (2, 2), (1, 1)], [(1, 1), (2, 2), (1, 1)]),
        ([(1, 1), (1, 1)], [(1, 1), (1, 1)]),
        ([(1, 1), (1, 1), (1, 1)], [(1, 1), (1, 1)]),
        ([(1, 1)], [(1, 1)]),
    ],
)
def test_drop_repeats(spark, before, after):
    assert pairs(spark, lines.drop_repeats(line(*before))) == after


def test_drop_repeats_of_nothing(spark):
    assert pairs(spark, lines.drop_repeats(F.lit(None).cast(lines.LINE_TYPE))) is None
    assert pairs(spark, lines.drop_repeats(F.array().cast(lines.LINE_TYPE))) == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"type":"LineString","coordinates":[[4.35,50.84],[4.36,50.85,12.0]]}', [(4.35, 50.84), (4.36, 50.85)]),
        ('{"type":"LineString","coordinates":[]}', []),
        ('{"type":"Point","coordinates":[4.35,50.84]}', None),
        ('{"type":"MultiPoint","coordinates":[[4.35,50.84]]}', None),
        ('{"type":"LineString","coordinates":[[4.35],[4.36,50.85]]}', None),
        ('{"type":"LineString","coordinates":[[4.35,null],[4.36,50.85]]}', None),
        ("text", None),
        (None, None),
    ],
)
def test_geojson_in(spark, text, expected):
    assert pairs(spark, lines.from_geojson(F.lit(text).cast("string"))) == expected


def test_geojson_out_rounds_and_ends_agree(spark):
    a = line((4.1234567891234, 50.0), (4.2, 51.0))
    assert value(spark, lines.to_geojson(a)) == '{"type":"LineString","coordinates":[[4.123456789,50.0],[4.2,51.0]]}'
    assert value(spark, lines.to_geojson(F.lit(None).cast(lines.LINE_TYPE))) is None
    assert value(spark, lines.line_start(a)["lat"]) == 50.0
    assert value(spark, lines.line_end(a)["lon"]) == 4.2
