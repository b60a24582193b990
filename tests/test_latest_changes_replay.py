"""Maintained latest readings, change events with keyed state, replay of the quarantine, numbered lines, texts of numbers."""

from pyspark.sql import functions as F

from conftest import raw_df, raw_row
from nimbus.functions import display as D
from nimbus.operators.decode import messages_to_raw
from nimbus.operators.series import latest_per_city
from nimbus.operators.staging import to_staging
from nimbus.sinks.manifest import Manifest
from nimbus.sources.files import read_messages
from nimbus.sources.tables import read_table
from nimbus.streaming.changes import start_changes
from nimbus.streaming.ingest import start_ingest
from nimbus.streaming.latest import BUCKETS, FOLD, latest_batch, read_latest
from nimbus.streaming.replay import replay
from nimbus.streaming.triggers import AVAILABLE_NOW, run_to_end


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_follows_any_order_and_merges_full_buckets(spark, tmp):
    batches = [to_staging(raw_df(spark, [raw_row(id=100 * n + c, city_id=c, timestamp=1744502461 + (7 * n + c) % 11) for c in (1, 1 + BUCKETS, 2)]))
               for n in range(FOLD + 3)]
    for n, b in enumerate(batches):
        latest_batch(b, n, f"{tmp}/latest", "w")
        latest_batch(b, n, f"{tmp}/latest", "w")
    every = batches[0]
    for b in batches[1:]:
        every = every.unionByName(b)
    assert rows(read_latest(spark, f"{tmp}/latest")) == rows(latest_per_city(every))
    assert rows(read_latest(spark, f"{tmp}/latest", 1 + BUCKETS)) == rows(latest_per_city(every).filter(F.col("city_id") == 1 + BUCKETS))
    assert read_latest(spark, f"{tmp}/latest", 5).isEmpty()
    assert max(len(Manifest(spark, f"{tmp}/latest").state().folders([c])) for c in (1, 2)) <= FOLD


def message(city, t, weather='[{"id":800,"main":"Clear"}]', name="x"):
    return f'{{"id":{city},"dt":{t},"name":"{name}","sys":{{"country":"N1"}},"weather":{weather}}}'


def put(tmp, name, lines):
    import os
    os.makedirs(f"{tmp}/topic", exist_ok=True)
    with open(f"{tmp}/topic/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_change_events_over_restarts(spark, tmp):
    """The time last seen outlives the query; a late reading differs from it; copies change nothing."""
    deliveries = [[message(1, 10), message(1, 10), message(2, 5)], [message(1, 10), message(1, 20)], [message(1, 20), message(2, 5)],
                  [message(1, 15)], [message(1, 20), message(2, 6)]]
    for n, lines in enumerate(deliveries):
        put(tmp, f"{n}.txt", lines)
        for _ in range(2):
            run_to_end(start_changes(read_messages(spark, f"{tmp}/topic"), f"{tmp}/changes", f"{tmp}/_ck", AVAILABLE_NOW))
    got = [(r.city_id, r.timestamp, r.previous) for r in read_table(spark, f"{tmp}/changes", "changes").collect()]
    assert sorted(got, key=repr) == sorted([(1, 10, None), (2, 5, None), (1, 20, 10), (1, 15, 20), (1, 20, 15), (2, 6, 5)], key=repr)


def test_equal_lines_have_ids_of_their_own(spark, tmp):
    put(tmp, "a.txt", [message(1, 10)] * 3 + ["", "broken"] * 2)
    put(tmp, "b.txt", [message(1, 10)])
    ids = []
    for _ in range(2):
        raw, bad = messages_to_raw(read_messages(spark, f"{tmp}/topic", stream=False))
        ids.append(sorted(r.id for r in raw.collect()))
        assert bad.count() == 4 and bad.select("msg_id").distinct().count() == 4
    assert len(set(ids[0])) == 4 and ids[0] == ids[1]
    plain, _ = messages_to_raw(read_messages(spark, f"{tmp}/topic", stream=False, numbered=False))
    assert plain.select("id").distinct().count() == 2


def test_lines_end_as_in_text_files(spark, tmp):
    import os
    os.makedirs(f"{tmp}/topic")
    with open(f"{tmp}/topic/a.txt", "wb") as f:
        f.write("eins\r\nzwei\n\ndrei ü".encode())
    open(f"{tmp}/topic/empty.txt", "w").close()
    read = {n: sorted(r.value for r in read_messages(spark, f"{tmp}/topic", stream=False, numbered=n).collect()) for n in (True, False)}
    assert read[True] == read[False] == sorted(["eins", "zwei", "", "drei ü"])


def test_large_files_are_numbered_in_splits(spark, tmp):
    """No task takes a file as a whole; numbers, paths and ids are those of whole files, in the batch and in the stream."""
    import os
    os.makedirs(f"{tmp}/topic/a +b%")
    want = {}
    for name, end in (("x", "\n"), ("y z", "\r\n"), ("w", "\r")):
        lines = [message(k % 7, 1744502461 + k // 9, "[]" if k % 11 == 5 else '[{"id":1},{"id":2}]') if k % 13 else "" for k in range(400)]
        with open(f"{tmp}/topic/a +b%/{name}.txt", "w", newline="") as f:
            f.write(end.join(lines) + end * (name != "w"))
        want |= {(f"file:{tmp}/topic/a +b%/{name}.txt", k): x for k, x in enumerate(lines)}
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        read = read_messages(spark, f"{tmp}/topic/*", stream=False)
        assert read.rdd.getNumPartitions() > 30
        assert {(r.file_path, r.line): r.value for r in read.collect()} == want
        run_to_end(start_ingest(read_messages(spark, f"{tmp}/topic/*", max_files_per_trigger=2), f"{tmp}/raw", f"{tmp}/quarantine", f"{tmp}/_ck", AVAILABLE_NOW))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    raw, bad = messages_to_raw(read_messages(spark, f"{tmp}/topic/*", stream=False))
    got = read_table(spark, f"{tmp}/raw", "raw")
    assert got.select("id").distinct().count() == got.count() > 1500
    assert rows(got.select(*raw.columns)) == rows(raw)
    assert rows(read_table(spark, f"{tmp}/quarantine", "quarantine").select(*bad.columns)) == rows(bad)


def test_times_last_seen_are_merged(spark, tmp, monkeypatch):
    """Many micro-batches: the state is folded, and each city keeps the time of the newest one, not the largest time."""
    from nimbus.streaming import changes
    monkeypatch.setattr(changes, "FOLD", 2)
    times = [10, 20, 15, 15, 30, 5]
    for n, t in enumerate(times):
        batch = spark.createDataFrame([(message(1, t), "f", 2 * n), (message(1, t), "f", 2 * n + 1)], "value string, file_path string, line int")
        for _ in range(2):
            changes.changes_batch(batch, n, f"{tmp}/changes", f"{tmp}/seen", "w")
    got = sorted((r.timestamp, r.previous or 0) for r in read_table(spark, f"{tmp}/changes", "changes").collect())
    assert got == sorted([(10, 0), (20, 10), (15, 20), (30, 15), (5, 30)])
    assert len(Manifest(spark, f"{tmp}/seen").state().folders([1])) <= 2


def test_corrected_messages_enter_raw_once_under_their_first_id(spark, tmp):
    good = message(1, 1744502461)
    put(tmp, "a.txt", [message(1, 1744502461, "[]"), message(2, 1744502462, "null"), "broken", message(3, 1744502463)])
    paths = [f"{tmp}/{t}" for t in ("raw", "quarantine", "replayed")]
    run_to_end(start_ingest(read_messages(spark, f"{tmp}/topic"), *paths[:2], f"{tmp}/_ck", AVAILABLE_NOW))
    held = {r.value: r.msg_id for r in read_table(spark, paths[1], "quarantine").collect()}
    assert len(held) == 3
    ids = [held[message(1, 1744502461, "[]")], held["broken"]]
    fixes = spark.createDataFrame([(ids[0], good), (ids[0], good), (ids[1], "still broken"), (12345, message(9, 9))], "msg_id long, value string")
    for _ in range(2):
        assert [r.reason for r in replay(fixes, *paths).collect()] == ["malformed"]
        raw = read_table(spark, paths[0], "raw")
        assert sorted(r.city_id for r in raw.collect()) == [1, 3]
        assert [r.msg_id for r in read_table(spark, paths[2], "replayed").collect()] == [ids[0]]
    # the id that the message would have had: hash of its identity and the position
    want = spark.createDataFrame([(ids[0],)], "m long").select(F.xxhash64("m", F.lit(0)).alias("id")).first().id
    assert read_table(spark, paths[0], "raw").filter("city_id = 1").first().id == want
    # a run that died between raw and the ledger
    import shutil
    shutil.rmtree(paths[2])
    replay(fixes, *paths)
    assert read_table(spark, paths[0], "raw").count() == 2 and read_table(spark, paths[2], "replayed").count() == 1


def test_texts_of_great_numbers(spark):
    df = spark.createDataFrame([(1e25,), (1e7,), (12.25,), (-0.04,), (1e300,), (float("nan"),), (None,), (123456789.5,)], "v double")
    got = [tuple(r) for r in df.select(D.metric_text("v", "x"), D.plain_text("v")).collect()]
    assert got[0] == ("10000000000000000905969664.0x", "1.0E25") or got[0][0].endswith(".0x")
    assert got[1] == ("10000000.0x", "10000000.0") and got[2] == ("12.3x", "12.25") and got[3][0] == "0.0x"
    assert got[4][0] and got[5][0] and got[6] == (None, None) and got[7][1] == "123456789.5"
    assert all(not t.endswith(".") for _, t in got if t)
