"""How often a query's plan reads the tables of the log: every reading parses the whole log again."""

import pytest

from tidelog.operators import merge
from tidelog.plans import catalog
from test_merge import FIELDS, SCHEMA


def readings(frame, column):
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation" in line and f"{column}#" in line for line in plan.splitlines())


def test_a_fold_computes_its_states_once(spark, tmp_path):
    events = [("a", "t", 0, n, 100 + n, 100 + n, n == 3, f"s{n}", n % 2) for n in range(8)]
    spark.createDataFrame(events, SCHEMA).write.parquet(str(tmp_path / "events"))
    states = merge.collapse(spark.read.parquet(str(tmp_path / "events")), FIELDS, apart=["batch"], gaps=True)
    assert readings(merge.fold(states, FIELDS), "kafka_ts_ms") == 1


def test_a_newest_row_that_is_a_candidate_stays_both(spark):
    # Two writes without a delete between them: the later one is the newest, and a first write should a delete turn up.
    rows = [("a", "t", 0, n, 100 + n, 100 + n, False, f"s{n}", 0) for n in (1, 5)]
    states = merge.collapse(spark.createDataFrame(rows, SCHEMA), FIELDS, gaps=True).collect()
    assert sorted((r["last_offset"] or 0, r["first_offset"], r["status"] or "") for r in states) == [(0, 5, ""), (5, 1, "s5")]


@pytest.mark.parametrize(
    "name, most",
    [
        # The live orders, which are the other side, read the table too.
        ("merge_interleaved_batches", 0),
        ("key_parity", 2),
        ("duplicate_keys", 1),
        ("insert_visible", 0),
        ("orders_by_source_time", 1),
    ],
)
def test_the_log_is_read_once(spark, sf_dir, name, most):
    """A query that stores its one reading has none left in its plan."""
    assert readings(catalog.all_queries()[name](spark, sf_dir), "o_totalprice") <= most
