import pytest

from helpers import csv_line, write_csv
from strikeloom.__main__ import parse, run
from strikeloom.checks.scratch import scratch_database, scratch_folder
from strikeloom.sinks.layers import gold_table, silver_table

CHAIN = ["SPX   250221C01000000", "SPX   250221C01100000", "SPX   250221P00900000",
         "SPXW  250221P00800000"]


def test_load_then_strategies(spark, tmp_path, capsys):
    database = scratch_database(spark)
    for stamp in ("20250127", "20250128"):
        write_csv(tmp_path / "landing", f"q-{stamp}.csv", [csv_line(s) for s in CHAIN])
    landing = str(tmp_path / "landing")
    load = ["--mode", "dataload", "--path", landing, "--database", database]
    assert run(spark, parse([*load, "--bootstrap"]))
    assert run(spark, parse(load))
    assert spark.table(silver_table(database)).count() == 8
    strategy = ["--mode", "strategy", "--database", database]
    assert run(spark, parse(strategy))
    assert spark.table(gold_table(database, "IronCondorStrategy")).count() == 2
    assert "IRON_CONDOR" in capsys.readouterr().out
    assert run(spark, parse([*strategy, "--strategies", "LaymanSPYStrategy"]))
    assert spark.table(gold_table(database, "LaymanSPYStrategy")).count() == 8
    assert not run(spark, parse([*strategy, "--strategies", "NoSuchStrategy"]))
    assert run(spark, parse(["--mode", "compact", "--database", database]))


def test_stream(spark, tmp_path):
    database = scratch_database(spark)
    write_csv(tmp_path / "landing", "q-20250127.csv", [csv_line(s) for s in CHAIN])
    arguments = ["--mode", "stream", "--path", str(tmp_path / "landing"), "--database", database]
    assert run(spark, parse([*arguments, "--checkpoint", scratch_folder(spark)]))
    assert spark.table(silver_table(database)).count() == 4


@pytest.mark.parametrize(
    "arguments",
    [[], ["--mode", "dataload"], ["--mode", "stream", "--path", "x"], ["--mode", "other"]],
)
def test_incomplete_arguments_are_refused(arguments):
    with pytest.raises(SystemExit):
        parse(arguments)
