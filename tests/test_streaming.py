"""Streams over hand-made message files: disorder, late rows, corrections, replays, restarts."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paystrata.model import (
    LATE_KEY, LATE_TRANSACTION, ONLINE_KEY, REALTIME_AGG, TRANSACTION, TRANSACTION_ONLINE, WINDOW_KEY,
)
from paystrata.operators.detail import clean_transactions
from paystrata.sources.keyed import KeyedLog
from paystrata.sources.lake import Lake
from paystrata.sources.lookup import publish_lookup
from paystrata.sources.topics import folder_topic, parse_messages, to_messages, write_folder
from paystrata.streaming import jobs, newest, windows
from paystrata.streaming.dedup import dedup_first, dedup_latest

START = datetime(2026, 9, 4, 10)


def at(seconds):
    return START + timedelta(seconds=seconds)


def transactions(spark, data):
    """(id, amount, customer, merchant, seconds after START)"""
    return spark.createDataFrame(
        [(i, None if a is None else Decimal(a), "CNY", c, "A" + (c or "")[1:], m, "PAYMENT",
          None if s is None else at(s)) for i, a, c, m, s in data], TRANSACTION)


def send(spark, path, turn, data):
    write_folder(to_messages(transactions(spark, data), ["customer_id"], decimals_as_text=True), path, turn)


def test_messages_round_trip_and_junk_becomes_null(spark):
    rows = transactions(spark, [("T1", "12.30", "C1", "M1", 7), ("T2", "5", "C1", None, 8)])
    messages = to_messages(rows, ["transaction_id"], decimals_as_text=True)
    first = messages.orderBy("key").first()
    assert first.key == '{"transaction_id":"T1"}'
    assert '"amount":"12.30"' in first.value and '"event_time":"2026-09-04T10:00:07.000Z"' in first.value
    assert '"merchant_id":null' in messages.orderBy("key").collect()[1].value
    assert sorted(map(tuple, parse_messages(messages).collect())) == sorted(map(tuple, rows.collect()))
    junk = spark.createDataFrame([("hello",), ("{}",), ('{"transaction_id":"T9","amount":"x"}',)], ["value"])
    parsed = parse_messages(junk.withColumn("key", F.lit(None).cast("string")))
    clean = clean_transactions(parsed)
    assert parsed.count() == 3 and clean.count() == 0
    assert clean._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1     # parsed once


def test_a_replayed_batch_is_not_sent_twice(spark, tmp_path):
    topic = str(tmp_path / "topic")
    for _ in range(2):
        send(spark, topic, 0, [("T1", 1, "C1", "M1", 0)])
    files = [p.name for p in (tmp_path / "topic" / "batch_id=0").glob("*.parquet")]
    send(spark, topic, 0, [("T1", 1, "C1", "M1", 0)])
    assert [p.name for p in (tmp_path / "topic" / "batch_id=0").glob("*.parquet")] == files


def test_dedup_emits_only_when_the_newest_row_changes(spark, tmp_path):
    raw, checkpoint, seen = str(tmp_path / "raw"), str(tmp_path / "checkpoint"), []
    turns = [
        [("T1", 10, "C1", "M1", 100), ("T1", 11, "C1", "M1", 90), ("T2", 20, "C1", "M1", 50)],
        [("T1", 12, "C1", "M1", 80)],                                     # older: nothing
        [("T1", 10, "C1", "M1", 100)],                                    # the same row again: nothing
        [("T2", 21, "C1", "M1", 60), ("T1", 5, "C1", "M1", 10)],          # newer for T2 only
        [("T3", 30, "C1", "M1", 1), ("T3", 30, "C1", "M1", 1)],           # a doubled message
    ]
    for turn, data in enumerate(turns):
        send(spark, raw, turn, data)
        out = dedup_latest(clean_transactions(parse_messages(folder_topic(spark, raw)), require_customer=True))
        rows = []
        jobs.start(out, "update", checkpoint, jobs.BACKLOG,
                   lambda batch, _: rows.extend((r.transaction_id, int(r.amount)) for r in batch.collect())
                   ).awaitTermination()
        seen.append(sorted(rows))
    assert seen == [[("T1", 10), ("T2", 20)], [], [], [("T2", 21)], [("T3", 30)]]


def test_a_batch_that_failed_after_its_write_is_emitted_again_unchanged(spark, tmp_path):
    raw, checkpoint, seen, fail = str(tmp_path / "raw"), str(tmp_path / "checkpoint"), [], [True]

    def write(batch, batch_id):
        seen.append((batch_id, sorted((r.transaction_id, int(r.amount)) for r in batch.collect()),
                     batch.sparkSession.conf.get("spark.sql.adaptive.enabled")))
        if batch_id == 1 and fail.pop():
            raise RuntimeError("executor lost")

    def run():
        out = dedup_latest(clean_transactions(parse_messages(folder_topic(spark, raw)), require_customer=True))
        jobs.start(out, "update", checkpoint, jobs.BACKLOG, write).awaitTermination()

    send(spark, raw, 0, [("T1", 1, "C1", "M1", 10), ("T2", 1, "C1", "M1", 10)])
    run()
    send(spark, raw, 1, [("T1", 2, "C1", "M1", 20), ("T2", 9, "C1", "M1", 5)])
    with pytest.raises(Exception, match="executor lost"):
        run()
    fail.append(False)
    run()
    assert seen == [(0, [("T1", 1), ("T2", 1)], "true"), (1, [("T1", 2)], "true"), (1, [("T1", 2)], "true")]


def test_one_transaction_with_very_many_copies(spark, tmp_path):
    """A third of all rows share one id: copies combine before the shuffle and the newest survives."""
    raw = str(tmp_path / "raw")
    rows = spark.range(0, 30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), "id")).alias("transaction_id"),
        (F.col("id") + 1).cast("decimal(18,2)").alias("amount"), F.lit("CNY").alias("currency"),
        F.lit("C1").alias("customer_id"), F.lit("A1").alias("account_id"), F.lit("M1").alias("merchant_id"),
        F.lit("PAYMENT").alias("transaction_type"), F.timestamp_seconds(F.lit(1788480000) + F.col("id"))
        .alias("event_time"))
    write_folder(to_messages(rows, ["customer_id"]), raw, 0)
    sink = KeyedLog(spark, str(tmp_path / "table"), TRANSACTION, ["transaction_id"])
    jobs.start(dedup_latest(parse_messages(folder_topic(spark, raw))), "update", str(tmp_path / "checkpoint"),
               jobs.BACKLOG, sink.upsert).awaitTermination()
    assert sink.latest().count() == 20001
    assert sink.latest().filter("transaction_id = 'HOT'").first().amount == Decimal("29998.00")


def _tags(spark, tmp_path, turns, ttl=newest.TTL_SECONDS):
    """What each run of one query over the messages of one more turn tags, as (kind, id, amount)."""
    raw, found = str(tmp_path / "raw"), []
    for turn, data in enumerate(turns):
        send(spark, raw, turn, data)
        out = []
        jobs.start(newest.tagged(folder_topic(spark, raw), ttl), "update", str(tmp_path / "checkpoint"), jobs.BACKLOG,
                   lambda rows, n: out.extend(rows.select("kind", "value").collect())).awaitTermination()
        rows = spark.createDataFrame(out, newest.TAGGED)
        found.append(sorted((kind, str(r.transaction_id), int(r.amount)) for kind in ("late", "newest")
                            for r in parse_messages(newest.of_kind(rows, kind)).collect()))
    return found


def test_late_rows_and_newest_rows_from_one_step(spark, tmp_path):
    turns = [
        [("T1", 1, "C1", "M1", 0), ("T2", 1, "C1", "M1", 60), ("T3", 1, "C1", "M1", 56), ("T3", 2, "C1", "M1", 56)],
        [("T4", 1, "C1", "M1", 54), ("T5", 1, "C1", "M1", 55), ("T6", 1, "C1", "M1", None), ("T7", -1, None, "M1", 0),
         ("T1", 5, "C1", "M1", -1), ("T3", 2, "C1", "M1", 56)],
        [],
        [("T8", 1, "C1", "M1", 54), ("T9", 1, "C1", "M1", 200), ("T2", 9, "C1", "M1", 61)],
        [("T10", 1, "C1", "M1", 194), ("T11", 1, "C1", "M1", 195), (None, 3, "C1", "M1", 2)],
    ]
    assert _tags(spark, tmp_path, turns) == [
        [("newest", "T1", 1), ("newest", "T2", 1), ("newest", "T3", 2)],
        # rows are late before they are clean; an older version and a copy are no newest rows
        [("late", "T1", 5), ("late", "T4", 1), ("late", "T7", -1), ("newest", "T4", 1), ("newest", "T5", 1)],
        [],
        [("late", "T8", 1), ("newest", "T2", 9), ("newest", "T8", 1), ("newest", "T9", 1)],
        [("late", "None", 3), ("late", "T10", 1), ("newest", "T10", 1), ("newest", "T11", 1)]]


def _state(spark, tmp_path):
    read = spark.read.format("statestore").option("path", str(tmp_path / "checkpoint"))
    return read.option("stateVarName", "newest").option("flattenCollectionTypes", "true").load()


def test_the_newest_row_is_forgotten_after_its_time(spark, tmp_path):
    many = [(f"T{n}", 1, "C1", "M1", 0) for n in range(200)]
    turns = [many, [("T500", 1, "C1", "M1", 30)], [("T1", 2, "C1", "M1", 40), ("T501", 1, "C1", "M1", 100)],
             [("T502", 1, "C1", "M1", 300)]]
    counts = []
    for k in range(len(turns)):
        found = _tags(spark, tmp_path, turns[:k + 1], ttl=60) if k == 0 else None
        if found is None:
            send(spark, str(tmp_path / "raw"), k, turns[k])
            jobs.start(newest.tagged(folder_topic(spark, str(tmp_path / "raw")), 60), "update", str(tmp_path / "checkpoint"),
                       jobs.BACKLOG, lambda rows, n: rows.count()).awaitTermination()
        counts.append(_state(spark, tmp_path).count())
    # 200 and one more; at 100 - 5 all are gone but T1, renewed at 40, and the last; at 300 - 5 all but the last
    assert counts == [200, 201, 2, 1]


def test_the_clean_job_reads_its_topic_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    _dimensions(spark, lake, "V1")
    send(spark, str(tmp_path / "raw"), 0, [("T1", 1, "C1", "M1", 0)])
    online = KeyedLog(spark, str(tmp_path / "online"), TRANSACTION_ONLINE, ONLINE_KEY)
    late = KeyedLog(spark, str(tmp_path / "late"), LATE_TRANSACTION, LATE_KEY)
    query = jobs.start_clean_job(folder_topic(spark, str(tmp_path / "raw")), lake, online, late, None,
                                 str(tmp_path / "checkpoint"), jobs.BACKLOG)
    query.awaitTermination()
    assert [len(p["sources"]) for p in query.recentProgress] == [1] * len(query.recentProgress)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1        # and each row of it once
    assert online.latest().count() == 1 and late.latest().count() == 0


def test_timed_batches_and_a_restart_with_nothing_kept_locally(spark, tmp_path):
    """Three batches under the ten-second trigger; before the third, the state is loaded anew from the checkpoint."""
    raw, out = str(tmp_path / "raw"), []

    def start():
        return jobs.start(newest.tagged(folder_topic(spark, raw)), "update", str(tmp_path / "checkpoint"), jobs.EVERY,
                          lambda rows, n: out.append(sorted((r.kind, '"T1"' in r.value) for r in rows.collect())))

    send(spark, raw, 0, [("T1", 1, "C1", "M1", 50)])
    query = start()
    query.processAllAvailable()
    send(spark, raw, 1, [("T2", 1, "C1", "M1", 100)])
    query.processAllAvailable()
    query.stop()
    assert [rows for rows in out if rows] == [[("newest", True)], [("newest", False)]]
    spark._jvm.org.apache.spark.sql.execution.streaming.state.StateStore.stop()       # drops all local copies of state
    out.clear()
    send(spark, raw, 2, [("T1", 7, "C1", "M1", 49), ("T3", 1, "C1", "M1", 101)])
    query = start()
    query.processAllAvailable()
    query.stop()
    # the older version of T1 is late by the watermark of before the restart, and not newer than what the state holds
    assert [rows for rows in out if rows] == [[("late", True), ("newest", False)]]


def _dimensions(spark, lake, level):
    customers = spark.createDataFrame([("C1", level, None, datetime(2025, 1, 1), "ACTIVE")],
                                      "customer_id string, level string, region string, register_time timestamp, "
                                      "status string")
    merchants = spark.createDataFrame([("M1", "food", "x", "HIGH", "ACTIVE")],
                                      ["merchant_id", "category", "region", "risk_level", "status"])
    publish_lookup(lake, customers, "lookup_customer", "customer_id", "dim:customer:")
    publish_lookup(lake, merchants, "lookup_merchant", "merchant_id", "dim:merchant:")


def test_clean_job_enriches_from_the_newest_lookup_and_feeds_the_windows(spark, tmp_path):
    lake, raw, topic = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "raw"), str(tmp_path / "topic")
    online = KeyedLog(spark, str(tmp_path / "online"), TRANSACTION_ONLINE, ONLINE_KEY)
    turns = [("V1", [("T1", 10, "C1", "M1", 0), ("T2", 20, "C9", None, 1), ("T3", 0, "C1", "M1", 2),
                     ("T4", -1, "C1", "M1", 3), ("T5", 5, None, "M1", 4), (None, 5, "C1", "M1", 5)]),
             ("V2", [("T6", 20000, "C1", "M1", 299), ("T7", 1, "C1", "M1", 300), ("T1", 99, "C1", "M1", -1)]),
             ("V2", [("T8", 1, "C1", "M1", 5000)])]
    sink = KeyedLog(spark, str(tmp_path / "windows"), REALTIME_AGG, WINDOW_KEY)
    for turn, (level, data) in enumerate(turns):
        _dimensions(spark, lake, level)
        send(spark, raw, turn, data)
        jobs.start_clean_job(folder_topic(spark, raw), lake, online, KeyedLog(spark, str(tmp_path / "late"), LATE_TRANSACTION, LATE_KEY),
                             lambda messages, n: write_folder(messages, topic, n), str(tmp_path / "clean"),
                             jobs.BACKLOG).awaitTermination()
        rows = parse_messages(folder_topic(spark, topic), TRANSACTION_ONLINE)
        jobs.start_window_job(rows, sink, str(tmp_path / "checkpoint"), jobs.BACKLOG).awaitTermination()
    found = {r.transaction_id: r for r in online.latest().collect()}
    assert set(found) == {"T1", "T2", "T6", "T7", "T8"}
    assert found["T1"].customer_level == "V1" and found["T6"].customer_level == "V2"
    assert found["T1"].customer_region == "" and found["T1"].customer_register_time == "2025-01-01 00:00:00"
    assert found["T2"].customer_level is None and found["T2"].merchant_risk_level is None
    assert int(found["T1"].amount) == 10            # the older version never replaced it
    closed = {(r.window_type, r.customer_id, (r.window_start - START).seconds if r.window_start >= START else -300):
              r for r in sink.latest().collect()}
    first = closed["TUMBLE", "C1", 0]
    assert (first.transaction_count, int(first.total_amount), int(first.large_txn_amount)) == (2, 20010, 20000)
    assert first.last_txn_time == at(299) and first.high_risk_txn_count == 2
    assert closed["TUMBLE", "C1", 300].transaction_count == 1        # a row on the bound opens the next window
    assert closed["HOP", "C1", 0].transaction_count == 3
    assert not any(r.window_start >= at(4800) for r in closed.values())     # still open


def _brute(data, size, slide):
    groups = defaultdict(list)
    for row in data:
        if row[1] > 0 and row[2] is not None:
            start = row[4] // slide * slide
            while start > row[4] - size:
                groups[start, row[2]].append(row)
                start -= slide
    return {(at(start), customer): (
        len({r[0] for r in rows} - {None}), len({r[3] for r in rows} - {None}), sum(Decimal(r[1]) for r in rows),
        sum(Decimal(r[1]) for r in rows if r[1] > 10000), at(min(r[4] for r in rows)), at(max(r[4] for r in rows)))
        for (start, customer), rows in groups.items()}


@pytest.mark.parametrize("kind", ["TUMBLE", "HOP"])
def test_windows_with_disorder_and_a_hot_customer_equal_brute_force(spark, tmp_path, kind):
    pick = random.Random(3)
    data, clock = [], 0
    for n in range(900):
        clock += pick.randint(0, 6)
        customer = "C1" if pick.random() < 0.4 else pick.choice(["C2", "C3", None])
        data.append((f"T{n // 2}", pick.choice([-5, 7, 20000]), customer, pick.choice(["M1", "M2", None]),
                     max(0, clock - pick.randint(0, 4))))
    rows_path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    sink = KeyedLog(spark, str(tmp_path / "table"), REALTIME_AGG, WINDOW_KEY)
    shape = windows.tumbling if kind == "TUMBLE" else windows.hopping
    for turn in range(3):           # one query, stopped and started again
        send(spark, rows_path, turn, data[turn * 300:(turn + 1) * 300])
        rows = parse_messages(folder_topic(spark, rows_path)).withColumn("merchant_risk_level", F.lit("LOW"))
        jobs.start_window_job(rows, sink, checkpoint, jobs.BACKLOG, shape).awaitTermination()
    size = 300 if kind == "TUMBLE" else 600
    last = max(row[4] for row in data if row[1] > 0 and row[2]) - 5
    expected = {key: value for key, value in _brute(data, size, 300).items() if key[0] + timedelta(seconds=size) <= at(last)}
    found = {(r.window_start, r.customer_id): (
        r.transaction_count, r.merchant_count, r.total_amount, r.large_txn_amount, r.first_txn_time, r.last_txn_time)
        for r in sink.latest().collect()}
    assert found == expected and len(found) > 10
    assert sink.rows().count() == len(found)        # a closed window is written once


def test_first_row_is_kept_and_forgotten(spark, tmp_path):
    """Copies within the time are dropped; a copy that comes much later counts as new, for the state is gone."""
    raw = str(tmp_path / "raw")
    sink = KeyedLog(spark, str(tmp_path / "out"), TRANSACTION, ["transaction_id"])
    for turn, data in enumerate([[("T1", 1, "C1", "M1", 0), ("T1", 2, "C1", "M1", 1)], [("T1", 3, "C1", "M1", 20), ("T2", 1, "C1", "M1", 500)],
                                 [("T3", 1, "C1", "M1", 600)], [("T1", 4, "C1", "M1", 700)]]):
        send(spark, raw, turn, data)
        first = dedup_first(parse_messages(folder_topic(spark, raw)), "60 seconds")
        jobs.start(first, "append", str(tmp_path / "checkpoint"), jobs.BACKLOG, sink.upsert).awaitTermination()
    seen = [(r.transaction_id, int(r.amount)) for r in sink.rows().collect()]
    assert len(seen) == 4 and {("T2", 1), ("T3", 1), ("T1", 4)} < set(seen)


def test_rows_are_reduced_to_panes_before_windows(spark, tmp_path):
    """Five members of a row before the first shuffle, one state for each step, and no row copied for each window."""
    rows = spark.readStream.schema(TRANSACTION_ONLINE).parquet(str(tmp_path)).withWatermark("event_time", windows.DELAY)
    plan = windows.both_windows(rows)._jdf.queryExecution().analyzed().toString().split("\n")
    steps = [next(w for w in ("Aggregate", "Expand", "Generate") if w in line) for line in plan
             if any(f"{w} " in line for w in ("Aggregate", "Expand", "Generate"))]
    # from the top: the two output rows, the window, the values of a window, panes in windows, panes, members
    assert steps.count("Aggregate") == 3 and steps.index("Expand") == len(steps) - 3 and steps[-2:] == ["Aggregate", "Generate"]
