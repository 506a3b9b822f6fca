"""Bad and borderline messages."""

import json

import pytest

from tapemill.operators.trades import (
    classify_messages,
    encode_trades,
    normalize_trades,
    parse_trades,
    rejected_trades,
    unparsed_trades,
)
from tapemill.schemas import TRADE_SCHEMA


def message(**changes):
    fields = {"E": 900, "T": 1000, "s": "BTC", "p": "10.5", "q": "2", "m": True} | changes
    return json.dumps({key: value for key, value in fields.items() if value is not ...})


def feed(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value string")


@pytest.mark.parametrize(
    ("value", "trade"),
    [
        (message(), (1000, "BTC", 10.5, 2.0, "sell")),
        (message(m=False), (1000, "BTC", 10.5, 2.0, "buy")),
        (message(m=...), (1000, "BTC", 10.5, 2.0, "buy")),
        (message(m=None), (1000, "BTC", 10.5, 2.0, "buy")),
        (message(T=0), (900, "BTC", 10.5, 2.0, "sell")),
        (message(T=...), (900, "BTC", 10.5, 2.0, "sell")),
        (message(p=10.5, q=2), (1000, "BTC", 10.5, 2.0, "sell")),
        (message(p=" 1e3 ", q="-0.25"), (1000, "BTC", 1000.0, -0.25, "sell")),
        (message(extra={"a": [1]}), (1000, "BTC", 10.5, 2.0, "sell")),
        (message(m=1), (1000, "BTC", 10.5, 2.0, "sell")),
        (message(m=0), (1000, "BTC", 10.5, 2.0, "buy")),
        (message(m=0.0), (1000, "BTC", 10.5, 2.0, "buy")),
        (message(m="true"), (1000, "BTC", 10.5, 2.0, "sell")),
        (message(m="false"), (1000, "BTC", 10.5, 2.0, "sell")),
        (message(m=""), (1000, "BTC", 10.5, 2.0, "buy")),
        (message(m=[]), (1000, "BTC", 10.5, 2.0, "buy")),
        (message(m={}), (1000, "BTC", 10.5, 2.0, "buy")),
        (message(m=[0]), (1000, "BTC", 10.5, 2.0, "sell")),
        (message(q="2000000000000000000"), (1000, "BTC", 10.5, 2e18, "sell")),
        (f" {message()}\n", (1000, "BTC", 10.5, 2.0, "sell")),
    ],
)
def test_accepted(spark, value, trade):
    assert [tuple(row) for row in normalize_trades(feed(spark, value)).collect()] == [trade]
    assert rejected_trades(feed(spark, value)).isEmpty()


@pytest.mark.parametrize(
    ("value", "reason"),
    [
        ("not json", "unreadable message"),
        ("", "unreadable message"),
        (None, "unreadable message"),
        ("[1, 2]", "unreadable message"),
        ('{"T": 5', "unreadable message"),
        ("{}", "unreadable message"),
        (message() + " trailing", "unreadable message"),
        (message() + message(), "unreadable message"),
        (message() + "," + message(), "unreadable message"),
        (message().replace('"', "'"), "unreadable message"),
        (message(T=..., E=...), "no event time"),
        (message(T=0, E=...), "no event time"),
        (message() + ',"message":' + message(), "unreadable message"),
        (message() + "]", "unreadable message"),
        (message() + "] trailing", "unreadable message"),
        ("[" + message() + "]", "unreadable message"),
        ("null", "unreadable message"),
        (message(T=1_700_000_000_000_000_000), "bad event time"),
        (message(T=1_700_000_000_000_000), "bad event time"),
        (message(T=-99_999_999_999_999_999), "bad event time"),
        (message(p="x"), "bad price"),
        (message(p=...), "bad price"),
        (message(p="1.5d"), "bad price"),
        (message(p="NaN"), "bad price"),
        (message(p="Infinity"), "bad price"),
        (message(p="10000000000"), "bad price"),
        (message(q="x"), "bad quantity"),
        (message(q=None), "bad quantity"),
        (message(s=...), "no symbol"),
    ],
)
def test_rejected_alone(spark, value, reason):
    messages = feed(spark, message(), value, message(T=2000))
    assert {row.ts for row in normalize_trades(messages).collect()} == {1000, 2000}
    assert [tuple(row) for row in rejected_trades(messages).collect()] == [(value, reason)]


def test_symbol_can_be_a_constant(spark):
    messages = feed(spark, message(s=...), message(s="ETH"), "junk")
    assert {row.symbol for row in normalize_trades(messages, "BTC").collect()} == {"BTC"}
    assert rejected_trades(messages, "BTC").count() == 1


def test_classify_covers_every_message(spark):
    messages = feed(spark, message(), "junk", message(p="x"))
    assert sorted((r.reason or "") for r in classify_messages(messages).collect()) == [
        "",
        "bad price",
        "unreadable message",
    ]


def test_encoded_trades_parse_back(spark):
    rows = [(1000, "BTC", 10.5, 2.0, "sell"), (1001, "ETH ₿ \"q\"", 0.00001, 1e9, None)]
    trades = spark.createDataFrame(rows, TRADE_SCHEMA)
    records = encode_trades(trades)
    assert [bytes(row.key).decode() for row in records.collect()] == [row[1] for row in rows]
    assert json.loads(bytes(records.first().value)) == dict(zip(TRADE_SCHEMA.fieldNames(), rows[0], strict=True))
    parsed = parse_trades(records)
    assert [tuple(row)[:5] for row in parsed.collect()] == rows
    assert [row.event_ms for row in parsed.selectExpr("unix_millis(event_time) event_ms").collect()] == [1000, 1001]


def test_unusable_records_do_not_reach_the_tables(spark):
    good = '{"ts": 1, "symbol": "A", "price": 1.0, "qty": 1.0}'
    bad = {
        "xyz": "unreadable message",
        '{"ts": "1", "symbol": "A", "price": 1.0, "qty": 1.0}': "no event time",
        '{"ts": 1, "symbol": "A", "price": "1", "qty": 1.0}': "bad price",
        '{"ts": 1, "symbol": "A", "price": 1.0, "qty": null}': "bad quantity",
        '{"ts": 1, "price": 1.0, "qty": 1.0}': "no symbol",
        '{"ts": 1700000000000000000, "symbol": "A", "price": 1.0, "qty": 1.0}': "bad event time",
        '{"ts": 1, "symbol": "A", "price": 1.0, "qty": 1e28}': "bad quantity",
    }
    messages = feed(spark, good, *bad)
    assert parse_trades(messages).count() == 1
    assert {row.value: row.reason for row in unparsed_trades(messages).collect()} == bad
