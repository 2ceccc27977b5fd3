from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cardloom.functions.scoring import LinearModel
from cardloom.operators.modelling import score_rows
from cardloom.schema import transactions_schema
from cardloom.sources.messages import decode_messages, encode_messages, stream_writer
from cardloom.streaming.jobs import clean_stream, drain_to_files, run_available, window_metrics

START = datetime(2024, 1, 1)


class Folder:
    """A folder of Parquet files that a file stream reads."""

    def __init__(self, spark, make, path):
        self.spark, self.make, self.path = spark, make, str(path)

    def add(self, *rows):
        self.make(*rows).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        reader = self.spark.readStream.schema(transactions_schema(wide_ids=True)).option("maxFilesPerTrigger", 1)
        return reader.parquet(self.path)


@pytest.fixture()
def folder(spark, make_transactions, tmp_path):
    return Folder(spark, make_transactions, tmp_path / "in")


def tx(number, day=0.0, **more):
    return {"transaction_id": number, "tx_datetime": START + timedelta(days=day), **more}


@pytest.mark.parametrize("combine", [True, False])
def test_copies_are_dropped_within_and_across_batches(folder, tmp_path, combine):
    folder.add(tx(1), tx(1, 1), tx(2), tx(3, customer_id=-1))
    folder.add(tx(2, 2), tx(4))
    out = drain_to_files(clean_stream(folder.stream(), combine=combine), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r.transaction_id for r in out.collect()) == [1, 2, 4]


def test_hot_transaction(folder, tmp_path):
    folder.add(*[tx(7, i / 1000) for i in range(300)], *[tx(i) for i in range(1000, 1600)])
    out = drain_to_files(clean_stream(folder.stream()), str(tmp_path / "out"), str(tmp_path / "state"))
    assert out.filter("transaction_id = 7").first().tx_datetime == START  # the earliest copy
    assert out.count() == 601 and out.select("transaction_id").distinct().count() == 601


def test_restart_goes_on_where_it_stopped(folder, tmp_path):
    def drain():
        return drain_to_files(clean_stream(folder.stream()), str(tmp_path / "out"), str(tmp_path / "state"))

    folder.add(tx(1), tx(2))
    assert drain().count() == 2
    assert drain().count() == 2  # nothing new
    folder.add(tx(2, 1), tx(3))
    assert sorted(r.transaction_id for r in drain().collect()) == [1, 2, 3]


def test_a_wrong_date_costs_no_other_row(folder, tmp_path):
    def drain():
        return drain_to_files(clean_stream(folder.stream()), str(tmp_path / "out"), str(tmp_path / "state"))

    folder.add(tx(1), tx(99, 365 * 7))  # seven years ahead, which the rules permit
    assert drain().count() == 2
    folder.add(*[tx(number, 1) for number in range(2, 12)], tx(1, 2))
    assert sorted(r.transaction_id for r in drain().collect()) == [*range(1, 12), 99]


def test_windows_are_emitted_once_closed(folder, tmp_path):
    model = LinearModel({"tx_amount": 1.0}, -50.0)
    folder.add(tx(1, 0.1, tx_amount=100.0, tx_fraud=1), tx(2, 0.2), tx(3, 1.5, tx_amount=60.0))
    folder.add(tx(4, 0.9, tx_amount=70.0), tx(5, 3.5))
    scored = score_rows(folder.stream(), model)
    out = drain_to_files(window_metrics(scored), str(tmp_path / "out"), str(tmp_path / "state"))
    got = {r.window_start.day: (r.rows, r.predicted_fraud, r.known_fraud) for r in out.collect()}
    assert got == {1: (3, 2, 1), 2: (1, 1, 0)}  # day 4 is still open


def test_a_wrong_date_makes_no_true_row_late_in_monitoring(folder, tmp_path, spark):
    from cardloom.plans.monitor import monitor

    model, scored, out = LinearModel({"tx_amount": 1.0}, -50.0), str(tmp_path / "scored"), str(tmp_path / "out")

    def run(*rows):
        score_rows(folder.make(*rows), model).coalesce(1).write.mode("append").parquet(scored)
        windows = monitor(spark, scored, out, str(tmp_path / "state"))
        return {r.window_start.day: (r.rows, round(r.mean_score, 3)) for r in windows.collect()}

    far = datetime.now() + timedelta(days=5 * 365)
    assert run(tx(1, 0.1), tx(2, 0.2, tx_amount=50.0), tx(99, tx_datetime=far), tx(98, tx_datetime=None)) == {1: (2, 0.25)}
    assert run(tx(3, 0.9), tx(4, 1.5, tx_amount=50.0), tx(5, 3.5)) == {1: (3, 0.167), 2: (1, 0.5), 4: (1, 0.0)}
    # Rows of days long past correct their windows; a run without new files changes nothing.
    late = {1: (4, 0.25), 2: (3, 0.5), 4: (2, 0.0)}
    assert run(tx(6, 0.5, tx_amount=50.0), tx(7, 1.1, tx_amount=50.0), tx(8, 1.2, tx_amount=50.0), tx(9, 3.6)) == late
    again = monitor(spark, scored, out, str(tmp_path / "state"))
    assert {r.window_start.day: (r.rows, round(r.mean_score, 3)) for r in again.collect()} == late
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{out}-misdated").collect()) == [98, 99]


def test_a_batch_of_windows_counts_once_and_rows_without_score_have_no_mean(make_transactions, tmp_path, spark):
    from cardloom.plans.monitor import windows
    from cardloom.streaming.jobs import merge_windows

    scored = score_rows(make_transactions(tx(1, tx_amount=50.0), tx(2, tx_amount=None), tx(3, 1, tx_amount=None)),
                        LinearModel({"tx_amount": 1.0}, -50.0))
    path = str(tmp_path / "windows")
    assert merge_windows(scored, path, "s", 0) and not merge_windows(scored, path, "s", 0)
    got = {r.window_start.day: (r.rows, r.mean_score) for r in windows(spark, path, scored.schema).collect()}
    assert got == {1: (2, 0.5), 2: (1, None)}


def test_every_message_is_scored_rejected_or_a_copy(spark, make_transactions, tmp_path):
    from cardloom.plans.stream import start_routed

    places = {name: str(tmp_path / name) for name in ("in", "state", "out", "bad")}

    def run(rows, *broken):
        messages = encode_messages(make_transactions(*rows)).selectExpr("key", "value")
        messages.union(spark.createDataFrame([(None, text) for text in broken], "key STRING, value STRING")).coalesce(
            1).write.mode("append").parquet(places["in"])
        start_routed(spark, LinearModel({"tx_amount": 1.0}, -50.0), "parquet", "parquet", places["state"], places["bad"],
                     places["in"], places["out"], enveloped=True, block_ids=10).awaitTermination()
        return (sorted(r.transaction_id for r in spark.read.parquet(places["out"]).collect()),
                sorted((tuple(r.reasons), r.line[:8]) for r in spark.read.parquet(places["bad"]).collect()),
                sorted((r.transaction_id, r.copies) for r in spark.read.parquet(places["bad"] + "-copies").collect()))

    scored, bad, copies = run([tx(1), tx(1, 1), tx(2), tx(3, customer_id=-1)], "no json", '{"transaction_id": 7', None)
    assert scored == [1, 2] and copies == [(1, 1)]
    assert [reasons for reasons, _ in bad] == [("customer_id",), ("malformed",), ("malformed",), ("malformed",)]
    scored, bad, copies = run([tx(1, -1), tx(25), tx(2), tx(2)])
    assert scored == [1, 2, 25] and copies == [(1, 1), (1, 1), (2, 2)] and len(bad) == 4


def test_merged_feed_equals_the_full_run(spark, tmp_path):
    from cardloom.plans.clean import clean_feed, merge_new_files

    feed = tmp_path / "feed"
    feed.mkdir()
    files = {  # the later copy of 7 comes first, and one copy fails a rule
        "a.txt": "7,2024-01-03 00:00:00,1,5,10.0,4,4,1,1\n8,2024-01-01 00:00:00,1,5,3.0,4,4,1,1\nno line",
        "b.txt": "7,2024-01-01 00:00:00,1,5,11.0,4,4,1,1\n9,2024-01-01 00:00:00,1,0,3.0,4,4,1,1",
        "c.txt": "7,2024-01-02 00:00:00,1,5,12.0,4,4,1,1\n",
    }
    for name, lines in files.items():
        (feed / name).write_text(lines)
        merged = merge_new_files(spark, str(feed), str(tmp_path / "t"), str(tmp_path / "s"), rejects=str(tmp_path / "bad"))
    whole = clean_feed(spark, str(feed), str(tmp_path / "whole"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    assert {r.transaction_id: r.tx_amount for r in merged.collect()} == {7: 11.0, 8: 3.0}
    assert sorted(tuple(r.reasons) for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == [("malformed",), ("terminal_id",)]


def test_linear_scores(make_transactions):
    rows = make_transactions(tx(1, tx_amount=50.0), tx(2, tx_amount=51.0), tx(3, tx_amount=None))
    got = score_rows(rows, LinearModel({"tx_amount": 1.0}, -50.0), keep=["transaction_id"]).collect()
    assert [(r.transaction_id, r.prediction) for r in got] == [(1, 0.0), (2, 1.0), (3, None)]
    assert got[0].score == 0.5


def test_rows_without_a_feature_come_back_unscored(spark, make_transactions):
    from cardloom.operators.modelling import fit_scorer

    train = make_transactions(*[tx(i, tx_amount=float(i), tx_time_seconds=i, tx_time_days=i % 7, tx_fraud=int(i > 20)) for i in range(40)])
    rows = make_transactions(tx(1), tx(2, tx_amount=None), tx(3, tx_amount=float("nan")), tx(4, tx_time_days=None))
    fitted = fit_scorer(train, regParam=0.1, maxIter=5)
    for model, none in ((fitted, {2, 3, 4}), (LinearModel({"tx_amount": 1.0}, -5.0), {2, 3})):
        got = score_rows(rows, model, keep=["transaction_id"]).collect()
        assert {r.transaction_id for r in got} == {1, 2, 3, 4}
        assert {r.transaction_id for r in got if r.score is None and r.prediction is None} == none


def test_rejects_and_days_of_new_files(spark, tmp_path):
    from cardloom.plans.clean import clean_new_files

    feed, places = tmp_path / "feed", [str(tmp_path / name) for name in ("out", "state", "bad")]
    feed.mkdir()
    lines = ["3000000000,2024-01-01 00:00:00,1,5,3.0,4,4,1,1", "no line", "2,2024-01-02 00:00:00,-1,5,3.0,4,4,1,1"]

    def run():
        return clean_new_files(spark, str(feed), places[0], places[1], rejects=places[2], by_day=True)

    (feed / "a.txt").write_text("\n".join(lines))
    assert [r.transaction_id for r in run().collect()] == [3000000000]
    (feed / "b.txt").write_text("4,2026-01-01 00:00:00,1,0,3.0,4,4,1,1")
    run()
    bad = {tuple(r.reasons): r.line for r in spark.read.parquet(places[2]).collect()}
    assert set(bad) == {("malformed",), ("customer_id",), ("terminal_id",)} and bad[("malformed",)] == "no line"
    assert (tmp_path / "out" / "tx_date=2024-01-01").is_dir()


def test_messages_round_trip(make_transactions):
    rows = make_transactions(tx(1, tx_datetime=datetime(2024, 1, 1, 1, 2, 3, 456789)), tx(2, tx_amount=None),
                             tx(3, tx_amount=1e-9))
    messages = encode_messages(rows)
    assert messages.columns == ["key", "value"]
    binary = messages.select(F.col("key").cast("binary"), F.col("value").cast("binary").alias("value"))
    back = decode_messages(binary)
    assert back.dtypes == rows.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_messages_that_are_no_transactions_are_dropped(spark):
    values = ["no json", '{"transaction_id": "x"}', None, '{"transaction_id": 5, "tx_fraud": 1}', '{"transaction_id": 6']
    got = decode_messages(spark.createDataFrame([(v,) for v in values], "value STRING")).collect()
    assert [(r.transaction_id, r.tx_fraud, r.tx_amount) for r in got] == [(5, 1, None)]


def test_file_sink_writer(folder, tmp_path, spark):
    folder.add(tx(1), tx(2))
    run_available(stream_writer(folder.stream(), "json", str(tmp_path / "state"), str(tmp_path / "out")))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
