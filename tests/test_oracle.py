"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF01, SF001
from tests.oracle import compare, duck

# The training-data queries have tests of their own in tests/llm.
QUERIES = {n: q for n, q in E.queries().items() if n not in E.LLM_QUERIES}
ORACLE = {n: q for n, q in E.oracle_sql().items() if n not in E.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, QUERIES[name], ORACLE[name], SF01)
    assert info["ok"], info


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF01).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_amount" in df.columns


def test_fixture_counts_match_survey(spark):
    from ledgerlake.sources import fixtures as fx
    from pyspark.sql import functions as F
    ev = fx.v_events(spark, SF01)
    got = {r[0]: r[1] for r in ev.groupBy("event_type").count().collect()}
    assert got == {"payment_created": 5969, "refund_initiated": 2017, "chargeback_filed": 2014}
    small = fx.v_events(spark, SF001).groupBy("event_type").count().collect()
    assert sorted(r[1] for r in small) == [199, 201, 600]
    assert ev.filter(F.col("event_type") == "payment_created").count() == 5969


def test_cleanse_outcome_matches_fixture_table(spark):
    from ledgerlake.operators.cleanse import cast_and_classify
    from ledgerlake.sources import fixtures as fx
    got = {r[0]: r[1] for r in cast_and_classify(fx.v_payments(spark, SF01))
           .groupBy("quarantine_reason").count().collect()}
    assert got == {None: 4679, "null_amount": 59, "non_positive_amount": 74, "invalid_currency": 535,
                   "null_currency": 533, "invalid_timestamp": 39, "null_customer_id": 50}


def test_ledger_status_counts_match_fixture(spark):
    from ledgerlake.plans.catalog import QUERIES as Q
    row = Q["a6_reconciliation_counts"](spark, SF01).first()
    assert (row.reconciled_exact, row.reconciled_within_tolerance, row.discrepancies,
            row.awaiting_settlement) == (28809, 5191, 2914, 16393)


# These write a scratch lake first and read it back; the oracle test holds their rows.
SCRATCH = {"w1_append_read_back", "w3_replace_partitions", "w7_delete_rows", "r1_nightly_gold",
           "r1_catchup_gold", "r2_gold_with_optimize", "t1_stream_ingest", "t3_stream_batch_counters", "t5_hourly_stream",
           "w6_quarantine_two_days", "s3_two_sources_same_batch", "r1_after_rewrite", "c3_by_day_equals_catchup",
           "r1_ledger", "a13_report_table", "a12_registry_table", "r1_moved_id", "m2_late_arrivals",
           "n4_incremental", "a12_incremental", "a13_after_correction", "m4_digest_feed"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SCRATCH))
def test_query_scans_the_given_tables(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "sf0.001/" in plan and "FileScan parquet" in plan, name
