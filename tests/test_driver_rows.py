"""Queries on overlaps broadcast a row a slide and nothing else, in any job they run, so the driver never holds a table of fields."""

import pytest

from histoweave.plans import QUERIES
from histoweave.plans.registry import Tables

SF = "/root/testdata/sf0.001"
NAMED = [
    "ag-16",
    "ag-19",
    "ag-23",
    "ag-39",
    "ag-39-weighted",
    "ag-40",
    "flt-08",
    "flt-12",
    "gr-01",
    "gr-02",
    "gr-03",
    "gr-04",
    "gr-05",
    "wn-02",
    "sp-15",
    "jn-20",
    "jn-25",
    "la-01",
    "la-03",
]


def broadcast_rows(spark, run) -> list[int]:
    """Rows of each broadcast of the queries that `run` starts."""
    store = spark._jsparkSession.sharedState().statusStore()

    def ids() -> dict:
        kept = store.executionsList()  # the last thousand
        return {e.executionId(): e for e in map(kept.apply, range(kept.size()))}

    before = max(ids(), default=-1)
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = []
    for e in (e for k, e in ids().items() if k > before):
        nodes, values = store.planGraph(e.executionId()).allNodes(), store.executionMetrics(e.executionId())
        for node in (nodes.apply(k) for k in range(nodes.size())):
            metrics = node.metrics()
            for m in (metrics.apply(k) for k in range(metrics.size())):
                if node.name().startswith("BroadcastExchange") and m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    found.append(int(values.apply(m.accumulatorId()).replace(",", "")))
    return found


@pytest.mark.parametrize("key", NAMED)
def test_only_a_row_a_slide_is_broadcast(spark, key):
    slides = Tables(spark, SF).rect.select("slide_id").distinct().count()
    rows = broadcast_rows(spark, lambda: QUERIES[key](spark, SF).write.format("noop").mode("overwrite").save())
    assert rows and max(rows) <= slides
