"""Keyed sinks: replaying a batch is idempotent; the last writer wins."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pulsemart.session import work_dir
from pulsemart.sources import sinks
from pulsemart.streaming.jobs import dau_batch_writer
from pulsemart.functions.dates import with_log_date_hour


def _rows(spark, path):
    return sorted(tuple(r) for r in sinks.read_upserted(spark, path).select("id", "v").collect())


def _batch(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, v string")


def test_upsert_replay_is_idempotent(spark):
    path = work_dir(spark, "test_upsert", fresh=True)
    b2 = _batch(spark, ("2", "c"))
    sinks.upsert(_batch(spark, ("1", "a"), ("2", "b")), path, 1, "id")
    sinks.upsert(b2, path, 2, "id")
    assert sinks.upsert(b2, path, 2, "id") == []  # replay after a failure
    assert _rows(spark, path) == [("1", "a"), ("2", "c")]


def test_the_order_column_outranks_the_batch(spark):
    path = work_dir(spark, "test_order", fresh=True)
    schema = "id string, seq long, v string"
    sinks.upsert(spark.createDataFrame([("1", 5, "a"), ("2", 1, "b"), ("2", 1, "b")], schema), path, 0, "id", "seq")
    sinks.upsert(spark.createDataFrame([("1", 4, "stale"), ("2", 2, "b2"), ("2", 1, "old")], schema), path, 1, "id", "seq")
    sinks.upsert(spark.createDataFrame([("1", 5, "same"), (None, 1, "n")], schema), path, 2, "id", "seq")
    got = sorted((r.id or "", r.seq, r.v) for r in sinks.read_upserted(spark, path).collect())
    assert got == [("", 1, "n"), ("1", 5, "same"), ("2", 2, "b2")]


def test_documents_without_id_get_one(spark):
    path = work_dir(spark, "test_docs", fresh=True)
    docs = spark.createDataFrame([(None, "x"), (None, "x"), ("d1", "y")], "doc_id string, v string")
    sinks.upsert_documents(docs, path, 1)
    got = sinks.read_upserted(spark, path).collect()
    assert len(got) == 3 and len({r.doc_id for r in got}) == 3 and all(r.doc_id for r in got)


def _files(spark, path):
    """(bucket, generation, file) of a keyed table, also of what no reader sees."""
    from pulsemart.sources.buckets import _path

    fs, p = _path(spark, f"{path}/data/_bucket=*/_generation=*/*.parquet")
    return {tuple(str(st.getPath()).split("/")[-3:]) for st in fs.globStatus(p) or []}


def test_a_small_batch_rewrites_only_its_buckets(spark):
    path = work_dir(spark, "test_buckets", fresh=True)
    all_rows = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("v"))
    assert sinks.upsert(all_rows, path, 0, "id", n_buckets=32) == list(range(32))
    before = _files(spark, path)
    hit = sinks.upsert(_batch(spark, ("7", "b"), ("4711", "b"), ("new", "b")), path, 1, "id", n_buckets=32)
    written = _files(spark, path) - before
    assert len(hit) <= 3 and {f[0] for f in written} == {f"_bucket={b}" for b in hit} and {f[1] for f in written} == {"_generation=1"}
    assert before <= _files(spark, path)          # the generation before stays for readers that have begun
    got = sinks.read_upserted(spark, path)
    assert got.count() == 5001 and got.filter("v = 'b'").count() == 3
    for i in (2, 3):
        sinks.upsert(_batch(spark, ("7", str(i))), path, i, "id", n_buckets=32)
    seven = [f[1] for f in _files(spark, path) if f[0] == f"_bucket={hit[0]}" or f[1] in ("_generation=2", "_generation=3")]
    assert {"_generation=2", "_generation=3"} <= set(seven) and sinks.read_upserted(spark, path).count() == 5001
    assert sum(1 for f in _files(spark, path) if f[1] == "_generation=1") <= len(hit) - 1


@pytest.mark.parametrize("dies_at", ["write", "commit", "clean"])
def test_readers_are_complete_at_every_crash_point(spark, monkeypatch, dies_at):
    from pulsemart.sources import buckets

    path = work_dir(spark, "test_crash", fresh=True)
    sinks.upsert(_batch(spark, ("1", "a"), ("2", "b"), ("3", "c")), path, 0, "id", n_buckets=4)
    begun = sinks.read_upserted(spark, path)                       # a reader that began before the batch

    class Died(Exception):
        pass

    def die(*args):
        raise Died

    if dies_at == "write":
        # half of the buckets were written: the other tasks never ran
        lost = _batch(spark, ("2", "half"), ("9", "half"))
        generation = lost.withColumn("_bucket", F.lit(0)).withColumn("_generation", F.lit(1))
        generation.write.partitionBy("_bucket", "_generation").mode("append").parquet(f"{path}/data")
    else:
        monkeypatch.setattr(buckets, "commit" if dies_at == "commit" else "remove_old", die)
        with pytest.raises(Died):
            sinks.upsert(_batch(spark, ("2", "x"), ("4", "d")), path, 1, "id", n_buckets=4)
        monkeypatch.undo()
    old, new = [("1", "a"), ("2", "b"), ("3", "c")], [("1", "a"), ("2", "x"), ("3", "c"), ("4", "d")]
    assert _rows(spark, path) == (new if dies_at == "clean" else old)
    assert sorted(tuple(r) for r in begun.select("id", "v").collect()) == old
    sinks.upsert(_batch(spark, ("2", "x"), ("4", "d")), path, 1, "id", n_buckets=4)     # the replayed batch
    assert _rows(spark, path) == new
    sinks.upsert(_batch(spark, ("3", "y")), path, 2, "id", n_buckets=4)
    assert _rows(spark, path) == [("1", "a"), ("2", "x"), ("3", "y"), ("4", "d")]


def test_buckets_follow_the_rows(spark):
    from pulsemart.sources.buckets import BUCKET_ROWS, buckets_for

    assert buckets_for(0) == buckets_for(150_000) == 8
    for rows in (54_000_000, 216_000_000):
        assert BUCKET_ROWS / 2 < rows / buckets_for(rows) <= BUCKET_ROWS


def test_micro_batches_grow_with_a_topic_not_in_number(spark, monkeypatch):
    """Every micro-batch rewrites the keyed table: a topic of 300 files was 19 of them."""
    from pulsemart.sources.tables import Tables
    from pulsemart.streaming import jobs

    monkeypatch.setattr(jobs, "TOPIC_FILE_RECORDS", 5)
    table, rollup = jobs._order_job(Tables(spark, "/root/testdata/sf0.001"), "test_batches")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert sinks.read_upserted(spark, table).count() == orders
    batches = spark.read.parquet(rollup)
    assert batches.select("_batch").distinct().count() <= jobs.TOPIC_BATCHES + 1
    assert batches.agg(F.sum("n")).first()[0] == orders


def test_the_first_batch_of_a_table_keeps_the_newest_row_of_a_key(spark):
    path = work_dir(spark, "test_first_batch", fresh=True)
    rows = [(str(i % 50), i, f"v{i}") for i in range(200)] + [(None, 1, "a"), (None, None, "z")]
    hit = sinks.upsert(spark.createDataFrame(rows, "id string, n long, v string"), path, 0, "id", tiebreak="n", n_buckets=4)
    assert hit == [0, 1, 2, 3]
    got = {(r.id, r.n, r.v) for r in sinks.read_upserted(spark, path).collect()}
    assert got == {(str(i % 50), i, f"v{i}") for i in range(150, 200)} | {(None, 1, "a")}


def test_a_batch_without_rows_and_an_empty_table(spark):
    path = work_dir(spark, "test_empty_batch", fresh=True)
    assert sinks.read_upserted(spark, path) is None
    none = _batch(spark, ("1", "a")).limit(0)
    assert sinks.upsert(none, path, 0, "id") == [] and sinks.read_upserted(spark, path) is None
    sinks.upsert(_batch(spark, ("1", "a")), path, 1, "id")
    sinks.upsert(none, path, 2, "id")
    assert _rows(spark, path) == [("1", "a")]


def test_stream_writer_survives_a_replayed_batch(spark):
    from pulsemart.streaming.jobs import upsert_each_batch

    path = work_dir(spark, "test_writer", fresh=True)
    write = upsert_each_batch(path, "id", "seq", 4)
    schema = "id string, seq long, v string"
    batches = [[("1", 1, "a"), ("2", 1, "b")], [("1", 2, "a2")], [("3", 1, "c")], [("2", 3, "b3")]]
    for i, rows in enumerate(batches):
        write(spark.createDataFrame(rows, schema), i)
        write(spark.createDataFrame(rows, schema), i)             # each replayed after a failure
    assert _rows(spark, path) == [("1", "a2"), ("2", "b3"), ("3", "c")]


def test_topic_options_and_keyed_records(spark):
    from pulsemart.sources.stream import source_options, topic_stream
    from pulsemart.streaming.jobs import run_available_now

    assert sinks.topic_options("b:9092") == {"kafka.bootstrap.servers": "b:9092", "kafka.acks": "all"}
    assert sinks.topic_options("b:9092", "T")["topic"] == "T"
    assert source_options("T", "b:9092", 10) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "T", "startingOffsets": "latest", "maxOffsetsPerTrigger": "10"}
    routed = spark.createDataFrame([("T", "k1", '{"a":"1"}'), ("T", None, "plain"), ("U", "k2", "")], "topic string, key string, value string")
    with pytest.raises(Exception, match="(?i)kafka"):
        sinks.send_topics(routed, "nowhere:1")
    base = work_dir(spark, "test_keyed", fresh=True)
    sinks.write_topics(routed, f"{base}/topics")
    stream = topic_stream(spark, "T", f"{base}/topics/topic=T", keyed=True)
    run_available_now(stream, f"{base}/ckpt", f"{base}/sink")
    got = {tuple(r) for r in spark.read.schema("key string, value string").parquet(f"{base}/sink").collect()}
    assert got == {("k1", '{"a":"1"}'), (None, "plain")}


def test_rollups_and_counts_are_written_once_a_batch(spark):
    """A batch replayed after its rows were stored keeps what it had counted."""
    base = work_dir(spark, "test_counts", fresh=True)
    write = dau_batch_writer(f"{base}/table", sums_path=f"{base}/sums")
    day = 1_704_067_200_000
    first = _dau_rows(spark, [("a", day, 1), ("a", day + 5, 2), ("b", day + 3_600_000, 3)])
    second = _dau_rows(spark, [("a", day + 9, 4), ("c", day + 7, 5), ("c", day + 8, 6), ("c", day + 9, 7)])
    for rows, n in ((first, 0), (second, 1), (second, 1)):
        write(rows, n)
    counts = sorted(tuple(r) for r in sinks.read_rollup(spark, f"{base}/sums/counts").collect())
    assert counts == [(0, 3, 3, 2), (1, 4, 3, 1)]          # batch, raw, not seen, distinct
    hours = sinks.read_rollup(spark, f"{base}/sums/hours").groupBy("logdate", "lh").agg(F.sum("n").alias("n")).collect()
    assert {(r.lh, r.n) for r in hours} == {("00", 2), ("01", 1)}
    assert sinks.read_dau_table(spark, f"{base}/table").count() == 3


def test_dau_batch_writer_replay_appends_nothing(spark):
    path = work_dir(spark, "test_dau_table", fresh=True)
    rows = [("m1", 1_704_067_200_000, 1), ("m1", 1_704_067_300_000, 2), ("m2", 1_704_153_600_000, 3)]
    batch = with_log_date_hour(spark.createDataFrame(rows, "mid string, ts long, event_id long"))
    write = dau_batch_writer(path)
    write(batch, 0)
    write(batch, 0)  # the same micro-batch again
    stored = sinks.read_dau_table(spark, path)
    assert sorted((r.mid, r.logdate, r.event_id) for r in stored.collect()) == [
        ("m1", "2024-01-01", 1), ("m2", "2024-01-02", 3)]
    assert [c for c in spark.read.parquet(path).columns if c != "LOGDATE"] == ["MID", "TS", "EVENT_ID", "LOGHOUR"]
    pruned = sinks.read_dau_table(spark, path, ["2024-01-02"]).collect()
    assert [r.mid for r in pruned] == ["m2"]


def _dau_rows(spark, rows):
    return with_log_date_hour(spark.createDataFrame(rows, "mid string, ts long, event_id long"))


def test_dau_day_compaction_keeps_rows_and_merges_files(spark):
    path = work_dir(spark, "test_dau_compact", fresh=True)
    day1, day2 = 1_704_067_200_000, 1_704_153_600_000
    for b in range(3):
        rows = [(f"m{b}-{i}", day1 + i * 1000, b * 100 + i) for i in range(5)]
        sinks.write_dau_rows(_dau_rows(spark, rows).repartition(3), path)
    sinks.write_dau_rows(_dau_rows(spark, [("x", day2, 999)]), path)
    before = sorted(tuple(r) for r in sinks.read_dau_table(spark, path).collect())
    files = sinks.dau_day_files(spark, path)
    assert files["2024-01-01"] >= 3 and files["2024-01-02"] == 1
    assert sinks.compact_dau_days(spark, path, ["2024-01-01"]) == ["2024-01-01"]
    after = sorted(tuple(r) for r in sinks.read_dau_table(spark, path).collect())
    assert after == before
    assert sinks.dau_day_files(spark, path) == {"2024-01-01": 1, "2024-01-02": 1}


def test_dau_day_compaction_finishes_a_staged_run(spark):
    path = work_dir(spark, "test_dau_compact_resume", fresh=True)
    day1 = 1_704_067_200_000
    rows = [(f"m{i}", day1 + i * 1000, i) for i in range(6)]
    sinks.write_dau_rows(_dau_rows(spark, rows).repartition(3), path)
    before = sorted(tuple(r) for r in sinks.read_dau_table(spark, path).collect())
    # a run that died after staging: the day partition was already dropped
    sinks.upper_case_columns(sinks.read_dau_table(spark, path)).write.partitionBy("LOGDATE").parquet(f"{path}.compacting")
    fs, p = sinks._fs(spark, f"{path}/LOGDATE=2024-01-01")
    fs.delete(p, True)
    assert sinks.compact_dau_days(spark, path) == []
    assert sorted(tuple(r) for r in sinks.read_dau_table(spark, path).collect()) == before


def test_dau_writer_compacts_days_with_many_files(spark):
    path = work_dir(spark, "test_dau_writer_compact", fresh=True)
    write = dau_batch_writer(path, compact_every=2, max_day_files=2)
    day1 = 1_704_067_200_000
    counts = []
    for b in range(3):
        rows = [(f"m{b}-{i}", day1 + i * 1000, b * 100 + i) for i in range(6)]
        write(_dau_rows(spark, rows).repartition(3), b)
        counts.append(sinks.dau_day_files(spark, path)["2024-01-01"])
    one_batch = counts[0]
    assert counts[1] > 2                      # two batches left more than the bound
    assert counts[2] <= 1 + one_batch         # batch 2 folded them into one file first
    assert sinks.read_dau_table(spark, path).count() == 18


def test_dau_day_compaction_spreads_a_large_day_over_files(spark, monkeypatch):
    path = work_dir(spark, "test_dau_compact_spread", fresh=True)
    day1 = 1_704_067_200_000
    rows = [(f"m{i}", day1 + i * 1000, i) for i in range(400)]
    sinks.write_dau_rows(_dau_rows(spark, rows).repartition(4), path)
    before = sorted(tuple(r) for r in sinks.read_dau_table(spark, path).collect())
    fs, p = sinks._fs(spark, f"{path}/LOGDATE=2024-01-01")
    size = fs.getContentSummary(p).getLength()
    monkeypatch.setattr(sinks, "TARGET_FILE_BYTES", max(1, size // 3))
    sinks.compact_dau_days(spark, path, ["2024-01-01"])
    assert sorted(tuple(r) for r in sinks.read_dau_table(spark, path).collect()) == before
    assert sinks.dau_day_files(spark, path)["2024-01-01"] > 1     # not one task for the whole day
