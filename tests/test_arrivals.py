"""The arrival stream and the batch load share one log."""

from datetime import datetime

from orderloom.streaming.arrivals import load_arrivals


def _arrive(drops, day):
    query = load_arrivals(drops.spark, str(drops.landing), drops.root,
                          clock=lambda: datetime(2024, 2, day))
    query.awaitTermination(120)
    assert query.exception() is None


def test_each_file_is_loaded_once(drops):
    drops.put("orders_1.csv", "id\n1\n")
    _arrive(drops, 1)
    assert drops.rows("orders", "id") == [(1,)]
    drops.put("orders_2.csv", "id\n2\n")
    drops.load()
    drops.put("orders_3.csv", "id\n3\n")
    _arrive(drops, 2)
    assert drops.rows("orders", "id") == [(1,), (2,), (3,)]
    _arrive(drops, 3)
    log = drops.audit().read("ingestion_log").collect()
    assert sorted(r["source_file"] for r in log) == [
        "orders_1.csv", "orders_2.csv", "orders_3.csv"]
