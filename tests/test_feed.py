from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardloom.functions.rules import parity_rules, strict_rules
from cardloom.operators.cleaning import clean, count_reject_reasons
from cardloom.operators.modelling import fit_scorer, score_rows
from cardloom.operators.profile import profile_missing, profile_violations
from cardloom.plans import clean as clean_plan
from cardloom.plans.clean import clean_feed, clean_new_files, feed_reports, parse_once, profile
from cardloom.schema import transactions_schema
from cardloom.sources import feed as feed_source
from cardloom.sources.events import load_transactions
from cardloom.sources.feed import read_feed, read_rejected_lines
from cardloom.sources.snapshots import open_table
from cardloom.sources.tables import read_table
from tests.conftest import SF_SMALL

EDGE = """# comment line
1,2019-08-22 06:51:03,0,711,70.91,5526663,63,0,0
2,2019-08-22 24:00:00,1,753,55.0,5486663,63,0,0
3,2019-13-01 00:00:00,1,753,55.0,5486663,63,0,0
4,,1,753,55.0,5486663,63,0,0
5,2017-01-01 00:00:00,1,753,55.0,5486663,63,0,0
6,2019-08-22 06:51:03,-999999,753,55.0,5486663,63,0,0
7,2019-08-22 06:51:03,1,Err,55.0,5486663,63,0,0
8,2019-08-22 06:51:03,1,,55.0,5486663,63,0,0
9,2019-08-22 06:51:03,1,0,55.0,5486663,63,0,0
10,2019-08-22 06:51:03,1,5,NaN,5486663,63,0,0
11,2019-08-22 06:51:03,1,5,0.0,0,63,1,3
1,2019-08-23 06:51:03,9,711,1.0,5526663,64,0,0
12,2019-08-22 06:51:03,1,5,3.0
13,2019-08-22 06:51:03,1,5,3.0,4,4,2,0
14,2019-08-22 06:51:03,1,5,3.0,4,4,1,4
15,2031-08-22 06:51:03,1,5,3.0,4,4,1,1
,2019-08-22 06:51:03,1,5,3.0,4,4,1,1
,2019-08-22 06:51:03,2,5,3.0,4,4,1,1
16,2019-08-22 06:51:03,1,5,-2.0,4,4,1,1
17,2019-08-22 06:51:03,1,5,2.0,4,4,1,1,99
18,2019-08-22 06:51:03,1,5,2.0,4,-4,1,1
"""


@pytest.fixture()
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.txt").write_text(EDGE)
    (folder / "b.csv").write_text("99,2019-08-22 06:51:03,1,5,2.0,4,4,1,1\n")
    return str(folder)


def test_well_formed_rows_do_not_depend_on_the_selection(spark, feed):
    rows = read_feed(spark, feed)
    assert len(rows.collect()) == 16
    assert rows.count() == 16
    assert rows.select("transaction_id").count() == 16
    assert len(rows.select("tx_fraud").collect()) == 16
    assert rows.agg({"tx_amount": "count"}).first()[0] == 16
    assert rows.filter("customer_id >= 0").select("transaction_id").count() == 15


def test_rejected_lines(spark, feed):
    rejected = read_rejected_lines(spark, feed)
    assert rejected.count() == 5
    assert sorted(int(r.line.split(",")[0]) for r in rejected.collect()) == [2, 3, 7, 12, 17]


def test_parity_rules_on_the_edge_feed(spark, feed):
    kept = [r.transaction_id for r in clean(read_feed(spark, feed), parity_rules()).collect()]
    assert sorted(kept, key=lambda i: (i is not None, i)) == [None, 1, 5, 10, 11, 15, 18]


def test_strict_rules_on_the_edge_feed(spark, feed):
    kept = clean(read_feed(spark, feed), strict_rules(end_day="2025-01-01")).collect()
    assert sorted(r.transaction_id for r in kept) == [1, 11]
    open_end = clean(read_feed(spark, feed), strict_rules()).collect()
    assert sorted(r.transaction_id for r in open_end) == [1, 11, 15]
    assert {r.customer_id for r in kept if r.transaction_id == 1} == {0}  # the earlier of the two


def test_schema_is_as_declared(spark, feed):
    assert [t for _, t in read_feed(spark, feed).dtypes] == ["bigint", "timestamp", "bigint", "bigint", "double"] + ["int"] * 4


def test_clean_job_writes_table_and_rejects(spark, feed, tmp_path):
    out, bad = str(tmp_path / "clean"), str(tmp_path / "bad")
    table = clean_feed(spark, feed, out, strict=False, rejects=bad)
    assert table.count() == 7
    assert read_table(spark, bad).count() == 5
    assert clean_feed(spark, feed, out, strict=True).count() == 3  # overwritten, not appended
    assert clean_feed(spark, feed, out, days=("2018-01-01", "2025-01-01")).count() == 2


def test_clean_job_by_day(spark, feed, tmp_path):
    table = clean_feed(spark, feed, str(tmp_path / "clean"), by_day=True)
    assert {str(r.tx_date) for r in table.select("tx_date").distinct().collect()} == {"2019-08-22", "2031-08-22"}


def test_new_files_are_appended(spark, feed, tmp_path):
    def drain():
        table = clean_new_files(spark, feed, str(tmp_path / "out"), str(tmp_path / "state"))
        return sorted(r.transaction_id for r in table.collect())

    assert drain() == [1, 11, 15]
    (tmp_path / "feed" / "c.txt").write_text(
        "11,2019-08-22 06:51:03,1,5,0.0,0,63,1,3\n20,2019-08-22 06:51:03,1,5,0.0,0,63,0,0\nbroken\n"
    )
    assert drain() == [1, 11, 15, 20]  # 11 was seen before
    assert drain() == [1, 11, 15, 20]


def test_empty_feed(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.txt").write_text("# nothing\n")
    rows = read_feed(spark, str(folder))
    assert rows.count() == 0
    assert clean(rows, strict_rules()).count() == 0


def test_profile_of_the_edge_feed(spark, feed):
    reports = profile(read_feed(spark, feed))
    violations = reports["violations"].first().asDict()
    assert violations == {
        "rows": 16, "year_out_of_range": 2, "month_out_of_range": 0, "day_out_of_range": 0,
        "transaction_id_not_positive": 0, "customer_id_negative": 1, "terminal_id_negative": 0,
        "tx_amount_not_positive": 2, "tx_time_seconds_not_positive": 1,
    }
    missing = {r.column: (r.nans, r.nulls) for r in reports["missing"].collect()}
    assert missing["tx_amount"] == (1, 0)
    assert missing["transaction_id"] == (0, 2)
    assert missing["terminal_id"] == (0, 1)
    assert "tx_datetime" not in missing
    # 13 different ids in 16 rows: id 1 comes twice, NULL twice and counts once
    assert reports["keys"].first()[0] == 14
    domains = {(r.column, r.value): r.rows for r in reports["domains"].collect()}
    assert domains[("tx_fraud", 2)] == 1 and domains[("tx_fraud_scenario", 4)] == 1
    reasons = {r.reason: r.rows for r in reports["reject_reasons"].collect()}
    assert reasons["transaction_id"] == 2 and reasons["tx_datetime"] == 2 and reasons["tx_time_days"] == 1


def test_one_parse_gives_rows_rejects_and_counters(spark, feed, tmp_path, monkeypatch):
    scans = []
    scan = feed_source._scan
    monkeypatch.setattr(feed_source, "_scan", lambda *args: scans.append(args) or scan(*args))
    rules = strict_rules("2018-01-01", "2025-01-01")
    parsed = parse_once(spark, feed, rules)
    (tmp_path / "feed" / "a.txt").write_text("# the text is not read again\n")
    assert len(scans) == 1
    assert parsed.counts["lines"] == 21 and parsed.counts["malformed"] == 5
    assert parsed.rows.count() == 16
    assert sorted(int(r.line.split(",")[0]) for r in parsed.malformed.collect()) == [2, 3, 7, 12, 17]
    reports = feed_reports(parsed)
    assert len(scans) == 1
    assert {r.reason: r.rows for r in reports["reject_reasons"].collect()} == {
        r.reason: r.rows for r in count_reject_reasons(parsed.rows, rules).collect()}
    assert reports["violations"].collect() == profile_violations(parsed.rows).collect()
    assert sorted(reports["missing"].collect()) == sorted(profile_missing(parsed.rows).collect())
    assert reports["lines"].first() == (21, 5) and reports["keys"].first()[0] == 14


def test_one_parse_of_an_empty_feed(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# nothing\n")
    parsed = parse_once(spark, str(tmp_path), strict_rules())
    assert parsed.counts["lines"] == parsed.rows.count() == parsed.malformed.count() == 0
    assert feed_reports(parsed)["reject_reasons"].count() == 0


def test_models_still_score_after_an_observed_parse(spark, feed):
    parse_once(spark, feed, strict_rules())
    cleaned = clean(load_transactions(spark, SF_SMALL), strict_rules())
    model = fit_scorer(cleaned)
    assert score_rows(cleaned, model).where("score IS NOT NULL").count() == cleaned.count()


def test_clean_job_with_profile_parses_the_text_once(spark, feed, tmp_path, monkeypatch):
    scans = []
    scan = feed_source._scan
    monkeypatch.setattr(feed_source, "_scan", lambda *args: scans.append(args) or scan(*args))
    out, bad, reports = (str(tmp_path / name) for name in ("clean", "bad", "reports"))
    table = clean_feed(spark, feed, out, strict=False, rejects=bad, profile_to=reports)
    assert len(scans) == 1
    assert table.count() == 7 and read_table(spark, bad).count() == 5
    assert read_table(spark, f"{reports}/violations").first().rows == 16


def test_clean_job_keeps_the_old_table_if_a_write_fails(spark, feed, tmp_path, monkeypatch):
    out = str(tmp_path / "clean")
    assert clean_feed(spark, feed, out, days=("2018-01-01", "2025-01-01"), snapshot=True).count() == 2

    def broken(rows, rules):
        half = clean_rows(rows, rules)
        return half.withColumn("tx_amount", F.expr("IF(transaction_id = 11, CAST(raise_error('lost') AS DOUBLE), tx_amount)"))

    clean_rows = clean_plan.clean
    with monkeypatch.context() as patch:
        patch.setattr(clean_plan, "clean", broken)
        with pytest.raises(Exception, match="lost"):
            clean_feed(spark, feed, out, snapshot=True)
    assert sorted(r.transaction_id for r in open_table(spark, out).collect()) == [1, 11]
    assert clean_feed(spark, feed, out, snapshot=True).count() == 3
    assert open_table(spark, out).columns == list(transactions_schema().names)
    with pytest.raises(ValueError):
        clean_feed(spark, feed, out, snapshot=True, by_day=True)
