import json

import pytest

from tillstream import schemas
from tillstream.operators.dau import dau_document
from tillstream.operators.ods import (
    WIDE_TOPICS,
    fan_out,
    parse_records,
    route_canal,
    route_logs,
    route_maxwell,
    to_messages,
)


def lines(table, *texts):
    return table("value string", *[(t,) for t in texts])


def test_logs_go_by_start(table, rows):
    blank = '{"start":"%s"}'
    texts = {
        '{"common":{"mid":"m1"},"start":{"entry":"icon"},"ts":1}': "STARTUP_LOG",
        '{"start":{}}': "STARTUP_LOG",
        '{"start":1}': "STARTUP_LOG",
        blank % "x": "STARTUP_LOG",
        blank % " ": "STARTUP_LOG",  # a no-break space is no white space here
        blank % "": "EVENT_LOG",
        blank % "  \\t ": "EVENT_LOG",
        blank % " ": "EVENT_LOG",
        '{"start":null}': "EVENT_LOG",
        '{"actions":[]}': "EVENT_LOG",
        "{}": "EVENT_LOG",
    }
    routed = route_logs(lines(table, *texts))
    assert {r.value: r.topic for r in routed.collect()} == texts


def test_broken_log_lines_are_rejected(table, rows):
    routed = route_logs(lines(table, "{broken", '{"start":"a"}', None, "", " ", "[1]", "null", '"start"'))
    broken = [("REJECTED_LOG", t) for t in ("{broken", "[1]", "null", '"start"')]
    assert rows(routed) == sorted([*broken, ("STARTUP_LOG", '{"start":"a"}')])


def test_maxwell_routes_listed_tables_with_data(table, rows):
    routed = route_maxwell(
        lines(
            table,
            '{"table":"order_info","type":"insert","data":{"id":1,"x":null,"n":{"a":[1]}}}',
            '{"table":"order_detail","data":{"id":"2"}}',
            '{"table":"order_info","data":{}}',
            '{"table":"order_info","data":{ }}',
            '{"table":"order_info"}',
            '{"table":"user_info","data":{"id":3}}',
            '{"data":{"id":4}}',
        )
    )
    assert rows(routed) == [
        ("ODS_ORDER_DETAIL", '{"id":"2"}'),
        ("ODS_ORDER_INFO", '{"id":1,"n":{"a":[1]},"x":null}'),
    ]


def test_payloads_keep_the_digits_of_numbers(table, rows):
    data = '{"a":12345678901234567.89,"b":100000000000.00,"c":1.10,"d":"1.10"}'
    kept = '{"a":12345678901234567.89,"b":100000000000,"c":1.1,"d":"1.10"}'
    head = '{"table":"order_info","data":'
    assert rows(route_maxwell(lines(table, f"{head}{data}}}"))) == [("ODS_ORDER_INFO", kept)]
    assert rows(route_canal(lines(table, f"{head}[{data}]}}"))) == [("ODS_ORDER_INFO", kept)]


def test_change_records_are_parsed_once(table, plan):
    assert plan(route_maxwell(lines(table, "{}"))).count("parseJson") == 1


def test_maxwell_takes_other_tables_when_told(table, rows):
    routed = route_maxwell(lines(table, '{"table":"user_info","data":{"id":3}}'), ["user_info"])
    assert rows(routed) == [("ODS_USER_INFO", '{"id":3}')]


@pytest.mark.parametrize("text", ['{"table":"order_info","data":[{"id":1}]}', '{"table":"order_info","data":"x"}', "{broken"])
def test_maxwell_stops_at_other_shapes(table, text):
    with pytest.raises(Exception):
        route_maxwell(lines(table, text)).collect()


def test_canal_sends_one_message_per_element(table, rows):
    routed = route_canal(
        lines(
            table,
            '{"table":"order_info","data":[{"id":"1","s":"a,b"},{"id":"2"}]}',
            '{"table":"user_info","data":[]}',
            '{"table":"sku_info","data":null}',
        )
    )
    assert rows(routed) == [("ODS_ORDER_INFO", '{"id":"1","s":"a,b"}'), ("ODS_ORDER_INFO", '{"id":"2"}')]


def test_canal_stops_at_other_shapes(table):
    with pytest.raises(Exception):
        route_canal(lines(table, '{"table":"order_info","data":{"id":1}}')).collect()


def test_parse_takes_quoted_and_bare_numbers(table):
    parsed = parse_records(
        lines(
            table,
            '{"id":"7","order_id":8,"sku_id":9,"order_price":"1.25","sku_num":2,"sku_name":"茶","extra":{"a":1}}',
            '{"id":10,"order_id":null,"order_price":"","sku_num":"null","sku_name":null}',
            None,
        ),
        schemas.DETAIL_RECORD,
    )
    assert parsed.schema == schemas.DETAIL_RECORD or parsed.columns == schemas.DETAIL_RECORD.names
    assert sorted(tuple(r) for r in parsed.collect()) == [
        (7, 8, 9, 1.25, 2, "茶", None),
        (10, 0, 0, 0.0, 0, None, None),
    ]


@pytest.mark.parametrize("text", ["{broken", '{"id":"x1"}', "", " ", "[1]", "null"])
def test_parse_stops_at_broken_records(table, text):
    with pytest.raises(Exception):
        parse_records(lines(table, text), schemas.DETAIL_RECORD).collect()


@pytest.mark.parametrize("number", ["5", "5.0", '"5"', '"5.00"', "5E0"])
def test_whole_numbers_may_have_a_point(table, number):
    parsed = parse_records(lines(table, f'{{"id":1,"sku_num":{number}}}'), schemas.DETAIL_RECORD)
    assert parsed.collect()[0].sku_num == 5


def test_parse_stops_at_a_fraction_in_a_whole_number(table):
    with pytest.raises(Exception):
        parse_records(lines(table, '{"id":1,"sku_num":5.7}'), schemas.DETAIL_RECORD).collect()


def test_parse_keeps_other_columns(table):
    df = table("key string, value string", ("k", '{"tm_id":"1","tm_name":"a"}'))
    assert parse_records(df, schemas.BASE_TRADEMARK).collect()[0].asDict() == {"tm_id": "1", "tm_name": "a", "key": "k"}


def test_parse_is_planned_once(table, plan):
    parsed = parse_records(lines(table, '{"id":1}'), schemas.ORDER_RECORD).where("id > 0 and user_id = 0")
    assert plan(parsed).count("from_json") == 1


def test_messages_leave_out_nulls_and_keep_zeros(table):
    df = table("id bigint, name string, amount double, n bigint", (5, None, 0.0, 0))
    message = to_messages(df, key="id", topic="T").collect()[0]
    assert (message.topic, message.key) == ("T", "5")
    assert json.loads(message.value) == {"id": 5, "amount": 0.0, "n": 0}
    assert to_messages(df).columns == ["value"]


def test_messages_are_routed_by_column(table, rows):
    df = table("id bigint, kind string", (1, "a"), (2, "b"))
    assert rows(to_messages(df, topic=df["kind"], columns=["id"])) == [("a", '{"id":1}'), ("b", '{"id":2}')]


def test_fan_out_sends_to_every_topic(table, rows):
    out = rows(fan_out(table("value string", ("x",), ("y",))))
    assert out == sorted((t, v) for t in WIDE_TOPICS for v in "xy")


@pytest.mark.parametrize("ts", ["1592409600000", '"1592409600000"'])
def test_dau_document(table, ts):
    text = f'{{"common":{{"mid":"m","uid":"u","ar":"110","ch":"web","vc":"v2"}},"start":{{}},"ts":{ts}}}'
    row = dau_document(lines(table, text)).collect()[0]
    assert tuple(row) == ("m", "u", "110", "web", "v2", "2020-06-17", "16", "00", 1592409600000)
