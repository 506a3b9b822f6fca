"""The whole chain, from messages to the hour table, against a plain row-by-row computation."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone
from decimal import ROUND_HALF_UP, Decimal

import pytest
from helpers import NOON, ms
from pyspark.sql import functions as F

from tapemill.operators.bars import hour_bars, minute_bars
from tapemill.operators.trades import classify_messages, encode_trades, normalize_trades, parse_trades


def random_message(rng):
    """A message, some of them damaged, and the trade it stands for (None: to be set aside)."""
    time = ms(NOON) + rng.randrange(0, 4 * 3600 * 1000)
    price = round(rng.choice([0.0001, 1, 300, 65000]) * rng.random(), 8)
    qty = round(rng.choice([0.001, 1, 5000]) * rng.random(), 6)
    fields = {"e": "trade", "E": time + 3, "T": time, "s": rng.choice("ABBBBBB"), "m": rng.random() < 0.5}
    fields |= {"p": f"{price:.8f}", "q": f"{qty:.6f}"}
    damage = rng.randrange(30)
    if damage == 0:
        return json.dumps(fields)[:-5], None
    if damage in (1, 2, 3):
        name = {1: "p", 2: "q", 3: "s"}[damage]
        if rng.random() < 0.5 or name == "s":
            del fields[name]
        else:
            fields[name] = rng.choice(["", "abc", "1.5f", "Infinity", "--1"])
        return json.dumps(fields), None
    if damage == 4:
        fields["T"] = rng.choice([0, None])
        time += 3
    if damage == 5:
        del fields["m"]
    side = "sell" if fields.get("m") else "buy"
    return json.dumps(fields), (time, fields["s"], price, qty, side)


def quantized(value, places):
    return value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


def start_of(time, seconds):
    at = datetime.fromtimestamp(time // 1000, timezone.utc).replace(tzinfo=None)
    return at - timedelta(seconds=(at.minute * 60 + at.second) % seconds)


def bars_of(trades):
    groups = defaultdict(list)
    for time, symbol, price, qty, _ in trades:
        groups[symbol, start_of(time, 60)].append((Decimal(repr(price)), Decimal(repr(qty))))
    out = {}
    for key, rows in groups.items():
        prices = [price for price, _ in rows]
        mean = quantized(sum(prices) / len(prices), 8)
        out[key] = (len(rows), quantized(sum(q for _, q in rows), 10), mean, min(prices), max(prices))
    return out


def hours_of(minutes):
    groups = defaultdict(list)
    for (symbol, start), bar in minutes.items():
        groups[symbol, start.replace(minute=0)].append(bar)
    return {
        key: (
            sum(b[0] for b in bars),
            sum(b[1] for b in bars),
            quantized(sum(b[2] for b in bars) / len(bars), 8),
            min(b[3] for b in bars),
            max(b[4] for b in bars),
        )
        for key, bars in groups.items()
    }


def collected(frame):
    plain = frame.withColumn("window_start_ts", F.col("window_start_ts").cast("timestamp_ntz"))
    return {(row[0], row[1]): tuple(row)[2:] for row in plain.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chain_equals_row_by_row(spark, seed):
    rng = random.Random(seed)
    pairs = [random_message(rng) for _ in range(4000)]
    expected = [trade for _, trade in pairs if trade]
    messages = spark.createDataFrame([(text,) for text, _ in pairs], "value string").repartition(5)
    trades = normalize_trades(messages)
    assert sorted(map(tuple, trades.collect())) == sorted(expected)
    rejected = classify_messages(messages).where("reason IS NOT NULL").select("value")
    assert sorted(row.value for row in rejected.collect()) == sorted(text for text, trade in pairs if not trade)
    minutes = minute_bars(parse_trades(encode_trades(trades)))
    assert collected(minutes) == bars_of(expected)
    assert collected(hour_bars(minutes)) == hours_of(bars_of(expected))
