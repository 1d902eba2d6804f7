"""The driver contract, and headline queries against their oracles at the smallest scale."""

import pytest

import __spark_entry__ as contract
from checks import QUERIES
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
HEADLINES = (
    "clean_trips", "located_trips", "weather_impact", "time_series_mart", "customer_preference", "upserted_trips",
    "dated_batches", "nearest_centres", "priced_trips", "streamed_upserts", "balance_trips",
)


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", HEADLINES)
def test_query_matches_its_oracle(spark, db, name):
    report = compare(QUERIES[name].run(spark, SF), QUERIES[name].sql, db)
    assert report["ok"], report


def test_contract(spark):
    assert contract.entry(spark).columns[0] == "trip_id"
    assert set(contract.oracle_sql()) <= set(contract.queries())
    # Only fitted forests have no SQL.
    assert set(QUERIES) - set(contract.oracle_sql()) == {
        "forest_predictions", "feature_importances"}


def test_big_side_of_fares_is_shuffled_once(spark):
    """Weather and cells are sent to the trips; trips move by trip id alone."""
    plan = QUERIES["fares_mart"].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("hashpartitioning(trip_id" in line for line in exchanges)


def test_survey_rows_are_covered():
    covered = {row for q in QUERIES.values() for row in q.covers}
    by_query = {f"A{i}" for i in range(1, 29)} | {f"X{i}" for i in range(1, 29)} - {"X16", "X17", "X18"}
    assert by_query <= covered
