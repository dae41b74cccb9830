import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", shuffle_partitions=4)


class Drops:
    """A landing folder and a warehouse, written and loaded one run at a time."""

    def __init__(self, spark, base):
        self.spark, self.day = spark, 0
        self.landing, self.root = base / "landing", str(base / "warehouse")
        self.landing.mkdir()

    def put(self, name, text):
        (self.landing / name).write_text(text, encoding="utf-8")

    def load(self, **options):
        from datetime import datetime, timedelta

        from orderloom.plans.ingest import IngestOptions, ingest
        self.day += 1
        status = ingest(self.spark, str(self.landing), self.root,
                        datetime(2024, 1, 1) + timedelta(days=self.day), IngestOptions(**options))
        return {r["source_file"]: r for r in status.collect()}

    def table(self, name):
        from orderloom.sources.raw import read_raw
        return read_raw(self.spark, self.root, name)

    def rows(self, name, *columns):
        return sorted(map(tuple, self.table(name).select(*columns).collect()), key=repr)

    def audit(self):
        from orderloom.sources.audit import Audit
        return Audit(self.spark, self.root)


@pytest.fixture
def drops(spark, tmp_path):
    return Drops(spark, tmp_path)
