from types import SimpleNamespace

from __spark_entry__ import entry
from strikeloom.checks.scratch import scratch_folder
from strikeloom.schema import CONDOR_COLUMNS
from strikeloom.sinks.shared import shared_folder


def test_entry_returns_condors(spark):
    frame = entry(spark)
    assert frame.columns == list(CONDOR_COLUMNS)
    assert frame.count() > 0


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark).startswith(f"{shared}/")
    assert scratch_folder(spark) != scratch_folder(spark)


class Settings(dict):
    """A session's settings, to try one that a running session does not let go of."""

    def get(self, key, default=None):
        return super().get(key, default)


def test_scratch_without_shared_folder_lies_in_the_warehouse():
    session = SimpleNamespace(conf=Settings({"spark.sql.warehouse.dir": "file:/warehouse/"}))
    for folder in (scratch_folder(session), shared_folder(session)):
        assert folder.startswith("file:/warehouse/_")
