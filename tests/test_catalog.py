from __future__ import annotations

import contextlib

import pytest

import __spark_entry__ as entry_points
import check
from tests.conftest import SF_SMALL

SLOW_WITHOUT_SQL = ("tune_candidate", "validate_models")


@pytest.fixture(scope="module")
def duck():
    return check.duck_tables(SF_SMALL)


def test_sql_belongs_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert sum(r.rows for r in rows) > 800


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - set(SLOW_WITHOUT_SQL)))
def test_query_equals_its_sql(spark, duck, name):
    same, note = check.compare(spark, duck, name, SF_SMALL)
    assert same is not False, note


def test_counts_of_the_known_fixture(spark):
    """Row counts known for the larger fixture."""
    from cardloom.functions.rules import parity_rules
    from cardloom.operators.cleaning import clean
    from cardloom.sources.events import load_transactions

    rows = load_transactions(spark, "/root/testdata/sf0.01")
    kept = clean(rows, parity_rules()).selectExpr(
        "count(*)", "sum(tx_fraud)", "count_if(isnan(tx_amount))", "sum(transaction_id)").first()
    assert rows.count() == 11000
    assert tuple(kept) == (9133, 997, 105, 45679644)


def test_other_queries_stay_without_the_training_data_operators(monkeypatch):
    def absent(name, *args):
        raise ImportError(name)

    monkeypatch.setattr(entry_points.importlib, "import_module", absent)
    with pytest.warns(UserWarning, match="left out") if entry_points.os.path.exists(
            entry_points.os.path.join(entry_points._HERE, "cardloom", "llm")) else contextlib.nullcontext():
        assert set(entry_points.queries()) == set(entry_points.QUERIES)
