"""Streams over several batches: state across batches, restarts and replays."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerbrook.operators import ordered, windows
from ledgerbrook.sources import lines, streams
from ledgerbrook.streaming import batches, processors, totals
from ledgerbrook.streaming.event_time import EventTimeWindows


def write_lines(folder, name, values):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes("".join(f"{x}\n" for x in values).encode())


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


def per_batch(df, *columns):
    out = defaultdict(list)
    for r in rows_of(df, "batch_id", *columns):
        out[r[0]].append(r[1:])
    return dict(out)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "root")


def test_word_count_per_batch(spark, tmp_path, root):
    folder = tmp_path / "in"
    write_lines(folder, "1.txt", ["a b a", ""])
    query = lambda: batches.store_batches(
        streams.text_files(spark, str(folder)), batches.space_word_counts, f"{root}/out", f"{root}/cp"
    ).awaitTermination()
    query()
    write_lines(folder, "2.txt", ["a c"])
    query()
    assert per_batch(batches.read_batches(spark, f"{root}/out"), "word", "n") == {
        0: [("", 1), ("a", 2), ("b", 1)], 1: [("a", 1), ("c", 1)],
    }


def test_sql_word_count_matches(spark, tmp_path, root):
    folder = tmp_path / "in"
    write_lines(folder, "1.txt", ["the cat the", "dog  x "])
    for name, work in (("sql", batches.sql_word_counts), ("df", batches.space_word_counts)):
        batches.store_batches(
            streams.text_files(spark, str(folder)), work, f"{root}/{name}", f"{root}/cp-{name}"
        ).awaitTermination()
    assert rows_of(batches.read_batches(spark, f"{root}/sql"), "word", "n") == rows_of(
        batches.read_batches(spark, f"{root}/df"), "word", "n"
    )


def test_queue_of_batches(spark, tmp_path, root):
    folder = str(tmp_path / "in")
    for _ in range(3):
        spark.range(1, 1001, numPartitions=1).toDF("value").write.mode("append").parquet(folder)
    stream = streams.parquet_files(spark, folder, files_per_batch=1)
    batches.store_batches(stream, batches.residue_counts, f"{root}/out", f"{root}/cp").awaitTermination()
    expected = [(i, 100) for i in range(10)]
    assert per_batch(batches.read_batches(spark, f"{root}/out"), "residue", "n") == {0: expected, 1: expected, 2: expected}


def test_union_grep(spark, tmp_path, root):
    for i in range(2):
        write_lines(tmp_path / f"in{i}", "1.txt", ["the one", "other", "none", "x"])
    stream = streams.union_streams([streams.text_files(spark, str(tmp_path / f"in{i}")) for i in range(2)])
    count = lambda df: batches.grep_count(df, "the")
    batches.store_batches(stream, count, f"{root}/out", f"{root}/cp").awaitTermination()
    assert rows_of(batches.read_batches(spark, f"{root}/out"), "batch_id", "n") == [(0, 4)]


def test_grep_counts_zero(spark):
    assert batches.grep_count(spark.createDataFrame([("x",)], "value string"), "the").first().n == 0


def test_denylist_survives_restart_and_replay(spark, tmp_path, root):
    folder = tmp_path / "in"
    deny = spark.createDataFrame([("a",), ("b",), ("a",)], "word string")
    query = lambda: batches.denylist_stream(streams.text_files(spark, str(folder)), deny, root).awaitTermination()
    write_lines(folder, "1.txt", ["a b c a"])
    query()
    write_lines(folder, "2.txt", ["a d"])
    query()
    # Lose the commit of the last batch: it runs again and overwrites its own rows.
    commits = tmp_path / "root" / "checkpoint" / "commits"
    for f in commits.glob("*1*"):
        f.unlink()
    query()
    out = batches.read_batches(spark, f"{root}/out")
    assert per_batch(out.where("NOT dropped"), "word", "n") == {0: [("c", 1)], 1: [("d", 1)]}
    assert rows_of(batches.dropped_total(spark, root)) == [(4,)]


def keyed_files(spark, folder, rows, files):
    size = -(-len(rows) // files)
    for i in range(files):
        part = rows[i * size:(i + 1) * size]
        spark.createDataFrame(part, "key string, seq int, value bigint").coalesce(1).write.parquet(f"{folder}/{i:02d}")
    reader = spark.readStream.schema("key string, seq int, value bigint")
    return reader.option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def make_rows(n=240):
    rng = random.Random(2)
    return [("hot" if rng.random() < 0.6 else f"k{rng.randrange(8)}", i, rng.randrange(-20, 50)) for i in range(n)]


def state(spark, root, transform, folder="out"):
    """Run a stateful query over what is there and give all rows that it has stored."""
    with processors.rocksdb(spark):
        batches.append_rows(transform, f"{root}/{folder}", f"{root}/cp").awaitTermination()
    return spark.read.parquet(f"{root}/{folder}")


def test_running_sums_over_batches(spark, tmp_path, root):
    """Sums go on across batches, start from the initial state, and follow the order of each batch's frame."""
    rows = make_rows()
    shuffled = [r for i in range(4) for r in random.Random(i).sample(rows[60 * i:60 * i + 60], 60)]
    stream = keyed_files(spark, str(tmp_path / "in"), shuffled, 4)
    seeds = spark.createDataFrame([("hot", 100), ("hot", 1), ("never", 1)], "key string, value bigint")
    out = state(spark, root, processors.running_sums(stream, "key", ["seq"], "value", seeds))
    whole = spark.createDataFrame(rows, "key string, seq int, value bigint")
    twin = ordered.running_sum(whole, "key", ["seq"], "value", initial=seeds.groupBy("key").agg(F.sum("value").alias("value")))
    assert rows_of(out, "key", "seq", "value", "running_sum") == rows_of(twin, "key", "seq", "value", "running_sum")


def test_running_sums_of_null_keys_nulls_and_large_values(spark, tmp_path, root):
    rows = [(None, 0, 1 << 60), (None, 1, None), ("a", 2, (1 << 53) + 1), ("a", 3, None), ("a", 4, 1), (None, 5, 5)]
    stream = keyed_files(spark, str(tmp_path / "in"), rows, 2)
    got = {r["seq"]: (r["key"], r["value"], r["running_sum"]) for r in state(spark, root, processors.running_sums(stream, "key", ["seq"], "value")).collect()}
    big, odd = 1 << 60, (1 << 53) + 1
    assert got == {0: (None, big, big), 1: (None, None, big), 2: ("a", odd, odd), 3: ("a", None, odd), 4: ("a", 1, odd + 1), 5: (None, 5, big + 5)}


def test_state_is_spark_s_own_and_a_replayed_batch_starts_from_it(spark, tmp_path, root):
    """The state folder holds changelogs of changed keys; a batch whose commit was lost gives the same rows."""
    rows = make_rows(120)
    stream = keyed_files(spark, str(tmp_path / "in"), rows, 3)
    transform = processors.running_sums(stream, "key", ["seq"], "value")
    before = rows_of(state(spark, root, transform))
    assert list((tmp_path / "root" / "cp" / "state").rglob("*.changelog"))
    for f in (tmp_path / "root" / "cp" / "commits").glob("*2*"):
        f.unlink()
    after = state(spark, root, transform)
    # The file sink knows that batch 2 was written and keeps its rows once.
    assert rows_of(after) == before
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != processors.ROCKSDB["spark.sql.streaming.stateStore.providerClass"]


@pytest.mark.parametrize("size", [1, 2, 3])
def test_count_windows_over_batches(spark, tmp_path, root, size):
    rows = [(k, i, v if i % 7 else None) for k, i, v in make_rows(150)]
    stream = keyed_files(spark, str(tmp_path / "in"), rows, 4)
    out = state(spark, root, processors.count_window_averages(stream, "key", ["seq"], "value", size))
    whole = spark.createDataFrame([(k, i, v or 0) for k, i, v in rows], "key string, seq int, value bigint")
    twin = ordered.count_window_avg(whole, "key", ["seq"], "value", size)
    assert rows_of(out, "key", "average") == rows_of(twin, "key", "average")


def test_open_count_windows_are_forgotten(spark, tmp_path, root):
    """A window of two values that waits longer than its time to live starts anew; a filled one is cleared."""
    folder = str(tmp_path / "in")
    schema = "key string, seq int, s bigint, value bigint"
    def feed(name, *rows):
        spark.createDataFrame([(k, i, s, v) for i, (k, s, v) in enumerate(rows)], schema).coalesce(1).write.parquet(f"{folder}/{name}")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/*").withColumn("ts", F.timestamp_seconds(F.col("s") + 1000))
        averages = processors.count_window_averages(stream, "key", ["seq"], "value", 2, ("ts", 100))
        return rows_of(state(spark, root, averages))
    assert feed(0, ("k", 0, 10), ("k", 10, 20), ("k", 20, 30), ("x", 20, 7)) == [("k", 15)]
    assert feed(1, ("x", 100, 9)) == [("k", 15), ("x", 8)]  # in time
    assert feed(2, ("y", 130, 1)) == [("k", 15), ("x", 8)]  # the watermark passes k's 30
    assert feed(3, ("k", 140, 50)) == [("k", 15), ("x", 8)]
    assert feed(4, ("k", 150, 70)) == [("k", 15), ("k", 60), ("x", 8)]


def test_category_totals_write_what_changes(spark, tmp_path, root):
    """A batch of ten rows over many categories writes at most ten totals and the grand total."""
    rows = [(f"k{i % 400:03d}", i, i) for i in range(1200)]
    rows += [(f"k{i % 3:03d}" if i % 5 else None, i, 10) for i in range(10)]
    stream = keyed_files(spark, str(tmp_path / "in"), rows[:1200], 1)
    with processors.rocksdb(spark):
        totals.category_totals_stream(stream, "key", "value", root).awaitTermination()
        spark.createDataFrame(rows[1200:], "key string, seq int, value bigint").coalesce(1).write.parquet(f"{tmp_path}/in/01")
        totals.category_totals_stream(stream, "key", "value", root).awaitTermination()
    changes = batches.read_batches(spark, f"{root}/changes")
    assert changes.where("batch_id = 0").count() == 401 and changes.where("batch_id = 1").count() == 5
    got = totals.current_totals(spark, root, "key").collect()
    expected = Counter()
    for key, _, value in rows:
        expected[key] += value
    assert {r.key: r.total for r in got} == dict(expected)
    assert {r.grand_total for r in got} == {sum(expected.values())}


def test_a_failed_batch_is_replayed(spark, tmp_path, root):
    """The batch fails after its write: started again, it overwrites its rows, and the stream goes on."""
    folder = tmp_path / "in"
    failures = []
    def fail_once(batch_id):
        if not failures:
            failures.append(batch_id)
            raise RuntimeError("after the write")
    def begin():
        return batches.store_batches(
            streams.text_files(spark, str(folder)), batches.space_word_counts, f"{root}/out", f"{root}/cp", after=fail_once
        )
    write_lines(folder, "1.txt", ["a b a"])
    assert batches.run_recovering(begin) == 1 and failures == [0]
    write_lines(folder, "2.txt", ["a"])
    assert batches.run_recovering(begin) == 0
    assert per_batch(batches.read_batches(spark, f"{root}/out"), "word", "n") == {0: [("a", 2), ("b", 1)], 1: [("a", 1)]}
    failures.clear()
    write_lines(folder, "3.txt", ["c"])
    with pytest.raises(StreamingQueryException):
        batches.run_recovering(begin, attempts=1)


def test_watermark_drops_late_rows(spark, tmp_path, root):
    folder = str(tmp_path / "in")
    minutes = [[0, 1, 12], [11, 30], [45], [2, 90]]
    for i, part in enumerate(minutes):
        spark.createDataFrame([(m * 60,) for m in part], "s bigint").coalesce(1).write.parquet(f"{folder}/{i}")
    stream = spark.readStream.schema("s bigint").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    events = stream.select(F.timestamp_seconds("s").alias("ts"), F.lit("x").alias("v")).withWatermark("ts", "5 minutes")
    counts = windows.tumbling_counts(events, "ts", 600, "v")
    batches.append_rows(counts, f"{root}/out", f"{root}/cp").awaitTermination()
    got = rows_of(spark.read.parquet(f"{root}/out").select(F.unix_timestamp("window_start") / 60, "n"))
    assert got == [(0.0, 2), (10.0, 2), (30.0, 1), (40.0, 1)]


def counted(spark, root, length, slide, delay):
    sums = {"n": F.lit(1).cast("bigint")}
    return EventTimeWindows(
        root, "ts", length, slide, delay, lambda df: windows.pane_sums(df, "ts", length, slide, ["v"], sums), "pane timestamp, v string, n bigint",
        lambda panes: windows.from_panes(panes, length, slide, ["v"], ["n"]),
    )


def minutes(spark, folder, *batch):
    for number, part in enumerate(batch):
        rows = spark.createDataFrame([(m, "x") for m in part], "m int, v string").coalesce(1)
        rows.select(F.timestamp_seconds(F.col("m") * 60 + 600_000_000).alias("ts"), "v").write.parquet(f"{folder}/{number}")
    return spark.readStream.schema("ts timestamp, v string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_windows_end_and_late_rows_are_kept_apart(spark, tmp_path, root):
    parts = [[0, 1, 12], [11, 30], [45], [2, 90, None, 41], [55, 80, 200]]
    made = counted(spark, root, 600, 600, 300)
    made.run(minutes(spark, str(tmp_path / "in"), *parts))
    open_ones = made.finished(spark).agg(F.sum("n")).first()[0]
    made.end(spark)
    start = ((F.unix_timestamp("window_start") - 600_000_000) / 60).cast("int")
    # Batch 3 has a watermark of 40, batch 4 one of 85, which the pane of 80 outlasts.
    assert rows_of(made.finished(spark).select(start, "n")) == [(0, 2), (10, 2), (30, 1), (40, 2), (80, 1), (90, 1), (200, 1)]
    late = made.late(spark).select("batch_id", ((F.unix_timestamp("ts") - 600_000_000) / 60).cast("int").alias("m")).collect()
    assert sorted((r.batch_id, r.m is None, r.m or 0) for r in late) == [(3, False, 2), (3, True, 0), (4, False, 55)]
    assert open_ones < 10 == made.finished(spark).agg(F.sum("n")).first()[0]
    made.end(spark)
    assert made.finished(spark).agg(F.sum("n")).first()[0] == 10


def test_sliding_windows_of_a_stream_and_its_bounded_panes(spark, tmp_path, root):
    """Over many batches the windows equal those of the table; what is stored of panes and state stays small."""
    draws = random.Random(1)
    parts = [[60 * i + draws.randrange(60) for _ in range(40)] for i in range(9)]
    made = counted(spark, root, 3600, 1200, 3600)
    stream = minutes(spark, str(tmp_path / "in"), *parts[:6])
    made.run(stream)
    kept = []
    for number, part in enumerate(parts[6:], 6):
        rows = spark.createDataFrame([(m, "x") for m in part], "m int, v string").coalesce(1)
        rows.select(F.timestamp_seconds(F.col("m") * 60 + 600_000_000).alias("ts"), "v").write.parquet(f"{tmp_path}/in/{number}")
        made.run(stream)
        kept.append(len(list((tmp_path / "root" / "panes").rglob("*.parquet"))))
    made.end(spark)
    whole = spark.createDataFrame([(m, "x") for p in parts for m in p], "m int, v string")
    whole = whole.select(F.timestamp_seconds(F.col("m") * 60 + 600_000_000).alias("ts"), "v")
    assert rows_of(made.finished(spark)) == rows_of(windows.sliding_counts(whole, "ts", 3600, 1200, "v"))
    assert made.late(spark).count() == 0 and max(kept[1:]) <= 4


def test_recovery_after_stop(spark, tmp_path, root):
    folder = tmp_path / "in"
    write_lines(folder, "1.txt", ["a", "b"])
    def start():
        return batches.append_rows(
            streams.text_files(spark, str(folder)), f"{root}/out", f"{root}/cp", interval="1 second"
        )
    query = start()
    query.processAllAvailable()
    query.stop()
    write_lines(folder, "2.txt", ["c"])
    query = start()
    query.processAllAvailable()
    query.stop()
    assert rows_of(spark.read.parquet(f"{root}/out")) == [("a",), ("b",), ("c",)]


def followed(spark, folder, root, **options):
    stream = spark.readStream.format("followed_lines").options(**options).load(str(folder))
    batches.store_batches(stream, lambda df: df, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return Counter(r.value for r in batches.read_batches(spark, f"{root}/out").collect())


def test_line_source_follows_growing_files(spark, tmp_path, root):
    spark.dataSource.register(lines.LineSource)
    folder = tmp_path / "in"
    write_lines(folder, "a.log", ["one", "", "drei ü"])
    with open(folder / "a.log", "a", encoding="utf-8") as f:
        f.write("unfin")
    # Ranges of 4 bytes cut every line somewhere.
    assert followed(spark, folder, root, rangeBytes=4) == Counter(["one", "", "drei ü"])
    with open(folder / "a.log", "a", encoding="utf-8") as f:
        f.write("ished\nlast\n")
    write_lines(folder, "b.log", ["b1"])
    assert followed(spark, folder, root, rangeBytes=4) == Counter(["one", "", "drei ü", "unfinished", "last", "b1"])


def test_line_source_opens_files_that_grew(tmp_path, monkeypatch):
    """The driver opens none; a batch has ranges of changed files only, each of which opens its own file once."""
    opened = []
    real = lines.opened
    monkeypatch.setattr(lines, "opened", lambda fs, path: opened.append(path.rpartition("/")[2]) or real(fs, path))
    for i in range(50):
        write_lines(tmp_path / "in", f"{i:02d}.log", [f"line {k} of {i}" for k in range(20)])
    reader = lines.LineSource({"path": str(tmp_path / "in"), "rangeBytes": "100"}).streamReader(None)
    first = reader.latestOffset()
    assert len(reader.partitions(reader.initialOffset(), first)) >= 50 and opened == []
    with open(tmp_path / "in" / "07.log", "a", encoding="utf-8") as f:
        f.write("more\nand ")
    second = reader.latestOffset()
    ranges = reader.partitions(first, second)
    assert opened == [] and [r.path.rpartition("/")[2] for r in ranges] == ["07.log"]
    assert [v for r in ranges for batch in reader.read(r) for v in batch["value"].to_pylist()] == ["more"] and opened == ["07.log"]
    with open(tmp_path / "in" / "07.log", "a", encoding="utf-8") as f:
        f.write("more\n")
    third = reader.latestOffset()
    assert [v for r in reader.partitions(second, third) for batch in reader.read(r) for v in batch["value"].to_pylist()] == ["and more"]
    assert reader.partitions(third, reader.latestOffset()) == []
    write_lines(tmp_path / "in", "07.log", ["new"])  # a file that was replaced begins anew
    assert [v for r in reader.partitions(third, reader.latestOffset()) for batch in reader.read(r) for v in batch["value"].to_pylist()] == ["new"]


@pytest.mark.parametrize("size", [1, 3, 7, 64, 10_000])
def test_byte_ranges_give_every_line_once(tmp_path, monkeypatch, size):
    monkeypatch.setattr(lines, "BLOCK_BYTES", 5)
    text = ["", "a", "ü" * 40, "x\ry", "", "日本語 text", "last"]
    write_lines(tmp_path / "in", "f", text)
    reader = lines.LineSource({"path": str(tmp_path / "in"), "rangeBytes": str(size)}).streamReader(None)
    ranges = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [v for r in ranges for batch in reader.read(r) for v in batch["value"].to_pylist()] == text


def test_keyed_state_takes_a_part_of_many_files_as_one_batch(spark, tmp_path, monkeypatch):
    """Four parts, four batches, though every part lies in several files whose times interleave."""
    from ledgerbrook.catalog import bindings, streams

    rng, checkpoints = random.Random(4), []
    rows = [(i, i, rng.randrange(6), rng.choice(["click", "view"]), float(i), f'{{"k": {rng.randrange(90)}}}') for i in range(400)]
    for i in range(5):
        part = spark.createDataFrame(rows[i::5], "event_id bigint, s bigint, user_id bigint, event_type string, value double, props string")
        part.select("event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props").coalesce(1).write.mode(
            "append"
        ).parquet(str(tmp_path / "events.parquet"))
    spark.range(7).withColumnRenamed("id", "s_suppkey").write.parquet(str(tmp_path / "supplier.parquet"))
    append = batches.append_rows
    monkeypatch.setattr(batches, "append_rows", lambda df, out, checkpoint: checkpoints.append(checkpoint) or append(df, out, checkpoint))
    monkeypatch.setattr(bindings, "table", lambda spark, d, name: spark.read.parquet(f"{d}/{name}.parquet"))
    expected, totals_now = {}, Counter({"click": 7})
    for event_id, _, _, kind, _, props in rows:
        totals_now[kind] += int(props[6:-1])
        expected[event_id] = totals_now[kind]
    got = streams.QUERIES["stream_running_sum"](spark, str(tmp_path))
    assert {r["event_id"]: r["running_sum"] for r in got.collect()} == expected
    assert len(list((Path(checkpoints[0]) / "commits").glob("[0-9]*"))) == streams.PARTS
