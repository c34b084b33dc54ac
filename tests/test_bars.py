import json
from datetime import date, timedelta
from uuid import uuid4

from strikeloom.__main__ import parse, run
from strikeloom.checks.scratch import scratch_database
from strikeloom.sinks.bars import absorb_bars, bars_table, stored_bars
from strikeloom.sinks.catalog import create_database
from strikeloom.sources.bars import bars_between, bars_for_requests, normalise_bars, read_bar_replies

DAY = 86_400_000
FIRST = 20_089 * DAY  # 2025-01-01


def test_bars(spark, tmp_path):
    replies = [
        {"ticker": "O:A", "status": "OK",
         "results": [{"t": FIRST + 5 * 3_600_000 + day * DAY, "c": 1.5 + day, "v": 10, "o": 1}
                     for day in range(4)]},
        {"ticker": "O:B", "results": [{"t": FIRST, "c": 7, "v": 2.5}]},
        {"ticker": "O:C"},
        {"ticker": "O:D", "results": []},
    ]
    (tmp_path / "replies.json").write_text("\n".join(map(json.dumps, replies)))
    bars = normalise_bars(read_bar_replies(spark, str(tmp_path)))
    assert bars.dtypes == [
        ("timestamp", "string"), ("symbol", "string"), ("close", "double"), ("volume", "double"),
    ]
    assert bars.count() == 5
    assert tuple(bars.where("symbol = 'O:B'").first()) == (str(FIRST), "O:B", 7.0, 2.5)
    kept = bars_between(bars, "O:A", "2025-01-02", "2025-01-03").collect()
    assert sorted(bar.close for bar in kept) == [2.5, 3.5]
    assert bars_between(bars, "O:C", "2025-01-01", "2025-12-31").count() == 0


def test_no_replies_keep_the_layout(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    bars = normalise_bars(read_bar_replies(spark, str(tmp_path)))
    assert bars.columns == ["timestamp", "symbol", "close", "volume"]
    assert bars.count() == 0


def test_requests_equal_brute_force(spark):
    # 400 days of one symbol, few of another; times within the day, and bars that cannot be dated.
    hours = [0, 13 * 3_600_000, DAY - 1]
    times = [FIRST + d * DAY + hours[d % 3] for d in range(400)]
    rows = [(str(t), "A", float(t % 97), 1.0) for t in times] + [(str(times[9]), "B", 2.0, 1.0)]
    odd = [("soon", "A", 1.0, 1.0), (None, "A", 1.0, 1.0), (str(times[0]), None, 1.0, 1.0)]
    bars = spark.createDataFrame(rows + odd, "timestamp string, symbol string, close double, volume double")
    days = ["1900-01-01", "2024-12-31", "2025-01-01", "2025-03-05", "2025-03-06", "2026-02-04", "2999-12-31", None]
    asked = [(f"{s} {a} {b}", s, a, b) for s in ("A", "B", "C", None) for a in days for b in days]
    asked += asked[:3]
    requests = spark.createDataFrame(asked, "request_id string, symbol string, start_date string, end_date string")
    found = bars_for_requests(bars, requests, bucket_days=7)
    assert found.columns == ["request_id", *bars.columns]
    got = sorted((r.request_id, int(r.timestamp)) for r in found.collect())

    def covers(start, end, t):
        day = str(date(1970, 1, 1) + timedelta(t // DAY))
        return (start is None or start <= day) and (end is None or day <= end)

    wanted = [
        (name, int(t)) for name, s, a, b in asked for t, symbol, *_ in rows if s == symbol and covers(a, b, int(t))
    ]
    assert got == sorted(wanted) and wanted
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_requests_of_empty_tables(spark):
    bars = spark.createDataFrame([], "timestamp string, symbol string, close double, volume double")
    requests = spark.createDataFrame([("r", "A", None, None)], "request_id string, symbol string, start_date date, end_date date")
    assert bars_for_requests(bars, requests).count() == 0
    assert bars_for_requests(bars, requests.limit(0)).count() == 0


def test_loaded_bars_are_replaced_one_by_one(spark, tmp_path):
    database = f"bars_{uuid4().hex}"
    create_database(spark, database, str(tmp_path / "db"))
    layout = "timestamp string, symbol string, close double, volume double"
    month = 31 * DAY
    first = [(str(FIRST), "A", 1.0, 1.0), (str(FIRST), None, 1.0, 1.0), ("soon", "A", 1.0, 1.0), (str(FIRST + month), "A", 1.0, 1.0)]
    absorb_bars(spark.createDataFrame(first, layout), database)
    second = [(str(FIRST), "A", 2.0, 1.0), (str(FIRST), "A", 2.0, 3.0), (str(FIRST), None, 5.0, None), ("soon", "A", 6.0, 1.0), (str(FIRST + DAY), "A", 7.0, 1.0)]
    for _ in range(2):
        absorb_bars(spark.createDataFrame(second, layout), database)
    absorb_bars(spark.createDataFrame([], layout), database)
    rows = stored_bars(spark, database)
    assert rows.columns == ["timestamp", "symbol", "close", "volume"]
    wanted = [second[1], second[2], second[3], second[4], first[3]]
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, wanted))
    assert {row.month for row in spark.table(bars_table(database)).select("month").collect()} == {None, "2025-01", "2025-02"}


def test_bars_from_the_command_line(spark, tmp_path):
    database = scratch_database(spark)
    reply = {"ticker": "O:B", "results": [{"t": FIRST, "c": 7, "v": 2.5}]}
    (tmp_path / "replies.json").write_text(json.dumps(reply))
    assert run(spark, parse(["--mode", "bars", "--path", str(tmp_path), "--database", database]))
    assert [tuple(row) for row in stored_bars(spark, database).collect()] == [(str(FIRST), "O:B", 7.0, 2.5)]
