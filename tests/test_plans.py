"""Plan checks: routing jobs are narrow (no Exchange), JVM-only and parse
each JSON text once; topic choice prunes directories."""

import pytest

from logweave.plans import jobs
from logweave.plans.inspect import plan_stats
from logweave.sources import derived as D
from logweave.sources.records import read_topics
from logweave.operators.grouped import latest_by_key

TABLES = {"fb": D.filebeat_records, "act": D.action_records, "tab": D.table_records,
          "pipe": D.pipe_records, "game": D.game_records, "mon": D.monthly_records}

CASES = [  # job, table, parses (one per JSON text the job reads)
    ("chat_rekey", "pipe", 1), ("log_split", "act", 2), ("chat_extract", "tab", 2),
    ("daily_feed", "game", 1), ("filebeat_dlq", "fb", 2), ("two_level_dlq", "fb", 2),
    ("db_feed", "fb", 2), ("monthly_split", "mon", 1), ("validate_pass", "fb", 1),
]


@pytest.fixture(scope="module")
def topic_tables(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("topics"))
    for name, fn in TABLES.items():
        fn(spark, sf_dir).write.partitionBy("topic").parquet(f"{root}/{name}")
    return root


@pytest.mark.parametrize("job,table,parses", CASES)
def test_job_plan(spark, topic_tables, job, table, parses):
    df = getattr(jobs, job)(read_topics(spark, f"{topic_tables}/{table}"))
    s = plan_stats(df)
    assert s["exchanges"] == 0
    assert s["python_nodes"] == 0
    # the second reader for very large records is called from its projection, once per parse; all else is compiled
    assert s["codegen_gaps"] <= parses
    assert s["parses"] == parses
    assert s["partition_filters"] and "topic" in s["partition_filters"][0]
    assert all("partition" not in rs and "offset" not in rs for rs in s["read_schema"])


def test_latest_by_key_partial_aggregation(spark, topic_tables):
    df = latest_by_key(read_topics(spark, f"{topic_tables}/fb"))
    from logweave.plans.inspect import formatted_plan
    plan = formatted_plan(df)
    assert plan.count("SortAggregate") >= 2    # a struct buffer: combined in sorted order, before and after the exchange
    assert "partial_max_by" in plan


def test_catalog_is_map_only_except_grouped(spark, sf_dir):
    """Every registered query runs without Python and without a shuffle,
    except the two that group (per-topic counts, latest value per key)."""
    from logweave.plans.catalog import QUERIES
    grouped = {"error_counts", "latest_by_key", "map_status"}
    for name, fn in QUERIES.items():
        s = plan_stats(fn(spark, sf_dir))
        assert s["python_nodes"] == 0, name
        assert s["parses"] <= 3, name      # envelope, payload, and the test table's own JSON column
        if name in grouped:
            assert s["exchanges"] >= 1, name
        else:
            assert s["exchanges"] == 0, name
