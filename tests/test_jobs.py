"""The command line, as far as it runs without a broker."""

import pytest
from helpers import NOON, at, bars, ms

from tapemill.jobs import main
from tapemill.sinks import BarTable


def test_minutes_hourly_dashboard(spark, tmp_path, capsys):
    landing = tmp_path / "landing"
    landing.mkdir()
    lines = [
        f'{{"ts":{ms(at(minutes=-m))},"symbol":"{s}","price":{m + 1},"qty":2}}' for m in range(90) for s in ("A", "B")
    ]
    lines += ["junk", f'{{"ts":{ms(NOON) * 1000},"symbol":"A","price":1,"qty":2}}']
    (landing / "trades.txt").write_text("\n".join(lines))
    table = ["--table", str(tmp_path / "minutes")]
    clock = ["--now", NOON.replace(tzinfo=None).isoformat()]
    main(["minutes", "--files", str(landing), "--checkpoint", str(tmp_path / "cp"), "--available-now", *table, "--rejects", str(tmp_path / "rejects")])
    assert {r.reason for r in spark.read.json(str(tmp_path / "rejects")).collect()} == {"unreadable message", "bad event time"}
    assert BarTable(spark, str(tmp_path / "minutes"), "hour").read().count() == 180
    main(["hourly", *table, "--hours", str(tmp_path / "hours"), "--backups", str(tmp_path / "backups"), *clock])
    assert {r.trade_cnt for r in BarTable(spark, str(tmp_path / "hours")).read().collect()} == {60, 1}
    main(["dashboard", *table, "--symbol", "A", *clock])
    shown = capsys.readouterr().out
    assert "trade_agg_1h" in shown and "kpi_text" in shown and "ingest_status" in shown


def test_the_dashboard_prints_every_row(spark, tmp_path, capsys):
    table = BarTable(spark, str(tmp_path / "minutes"))
    table.upsert(bars(spark, [(f"S{k}", at(minutes=-m), 1, 1, m + 1) for k in range(7) for m in range(60)]))
    main(["dashboard", "--table", str(tmp_path / "minutes"), "--now", NOON.replace(tzinfo=None).isoformat()])
    frames = capsys.readouterr().out
    series = frames.split("price_series\n")[1].split("volume_series\n")[0].splitlines()
    assert len(series) == 1 + 7 * 60


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        main(["minutes"])
