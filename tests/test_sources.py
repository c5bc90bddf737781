"""Reader and writer over real files, streaming over real folders."""

import gzip
import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pitlake.sources import layout, reader, writer
from pitlake.streaming import control, ingest, watch

BASE = datetime(2024, 1, 1)


def bars(spark, rows):
    return spark.createDataFrame(rows, "event_id string, instrument_key string, instrument_type string, ts_event timestamp_ntz, ts_ingest timestamp_ntz, ts_available timestamp_ntz, timeframe string, close double")


def row(i, key="equity:A", hours=0, late=1, close=1.0, frame="1Day"):
    at = BASE + timedelta(hours=hours)
    return (f"e{i}", key, "equity", at, at, at + timedelta(hours=late), frame, close)


def test_silver_round_trip(spark, tmp_path):
    root = f"file://{tmp_path}"
    writer.write_silver(bars(spark, [row(0), row(1, hours=1), row(2, hours=30), row(3, "equity:B", 2, frame="1Min")]), root, "bars")
    lake = reader.Lake(spark, root)
    assert lake.silver("bars").count() == 4
    assert lake.silver("bars", time_range=(BASE, BASE + timedelta(hours=2))).count() == 3
    assert lake.asof("bars", BASE + timedelta(hours=2)).count() == 2
    assert lake.silver("bars", keys=["equity:B"], timeframe="1Min", columns=["close"]).columns == ["close", "instrument_key", "ts_available", "ts_event"]
    assert lake.silver("quotes").count() == 0
    plan = lake.silver("bars", time_range=(BASE, BASE + timedelta(hours=2)))._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan


def test_asof_grows_with_time(spark, tmp_path):
    root = f"file://{tmp_path}"
    writer.write_silver(bars(spark, [row(i, hours=i, late=5 - i) for i in range(5)]), root, "bars")
    lake = reader.Lake(spark, root)
    counts = [lake.asof("bars", BASE + timedelta(hours=h)).count() for h in range(7)]
    assert counts == sorted(counts) and counts[-1] == 5


def test_underscored_and_empty_files(spark, tmp_path):
    root = f"file://{tmp_path}"
    writer.write_silver(bars(spark, [row(0)]), root, "bars")
    hidden = tmp_path / "silver/feed=bars/_quarantine"
    hidden.mkdir()
    (hidden / "x.parquet").write_bytes(b"not parquet")
    assert reader.Lake(spark, root).silver("bars").count() == 1
    bad = tmp_path / "silver/feed=quotes/dt=2024-01-01"
    bad.mkdir(parents=True)
    (bad / "x.parquet").write_bytes(b"")
    with pytest.raises(reader.ReadError):
        reader.Lake(spark, root).silver("quotes")


def test_schemas_are_unified(spark, tmp_path):
    spark.createDataFrame([(1, 1)], "a int, b long").write.parquet(f"{tmp_path}/t/dt=2024-01-01")
    spark.createDataFrame([(2, 2.5, "x")], "a int, b double, c string").write.parquet(f"{tmp_path}/t/dt=2024-01-02")
    df = reader.read_unified(spark, f"file://{tmp_path}/t")
    assert df.schema["b"].dataType.simpleString() == "double"
    assert sorted((r["a"], r["b"], r["c"]) for r in df.collect()) == [(1, 1.0, None), (2, 2.5, "x")]
    spark.createDataFrame([(3, "s")], "a int, b string").write.parquet(f"{tmp_path}/t/dt=2024-01-03")
    with pytest.raises(reader.ReadError):
        reader.read_unified(spark, f"file://{tmp_path}/t")
    assert reader.read_unified(spark, f"file://{tmp_path}/t", "2024-01-02", "2024-01-02").count() == 1


def test_gold_versions_and_leakage(spark, tmp_path):
    root = f"file://{tmp_path}"
    for version, close in (("v9", 9.0), ("v10", 10.0), ("1.0.0", 1.0)):
        assert writer.write_gold(bars(spark, [row(0, close=close)]), root, "d", "p", version, {"v": version}) == 1
    lake = reader.Lake(spark, root)
    assert lake.gold("d", "p").first()["close"] == 1.0
    assert lake.gold("d", "p", "v9").first()["close"] == 9.0
    assert reader.versions(spark, f"{root}/gold/dataset=d/project=p") == ["1.0.0", "v9", "v10"]
    assert lake.gold("d", "p", asof=BASE).count() == 0
    with pytest.raises(writer.LeakageError):
        writer.write_gold(bars(spark, [row(0, late=-1)]), root, "d", "p", "v1")
    bare = spark.createDataFrame([("equity:A", BASE)], "instrument_key string, ts_event timestamp_ntz")
    bare.write.parquet(f"{root}/gold/dataset=bare/project=p/version=v1")
    with pytest.raises(reader.ReadError):
        lake.gold("bare", "p", asof=BASE)


def test_labels(spark, tmp_path):
    root = f"file://{tmp_path}"
    writer.write_label(bars(spark, [row(0), row(1, hours=5)]), root, "l", "1.0.0", {"horizon": "5d"})
    assert reader.Lake(spark, root).label("l", BASE + timedelta(hours=2)).count() == 1


def test_compact_promote_upsert(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    schema = "event_id int, ts_ingest int, v string"
    values = lambda: {r["v"] for r in reader.read_unified(spark, path).collect()}
    for rows in ([(1, 5, "late"), (2, 1, "x")], [(1, 3, "early")], [(None, 1, "none"), (None, 1, "none")]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
    assert writer.compact(spark, path) == 4 and values() == {"early", "x", "none"}
    spark.createDataFrame([(1, 9, "again"), (4, 1, "four")], schema).write.mode("append").parquet(path)
    assert values() == {"early", "x", "none", "again", "four"}  # what came since is seen beside the compacted rows
    assert writer.compact(spark, path) == 5 and values() == {"early", "x", "none", "four"}
    spark.createDataFrame([(2, 9, "newer"), (3, 1, "new")], schema).write.mode("append").parquet(f"{path}_backfill")
    writer.promote(spark, path, f"{path}_backfill")
    assert values() == {"early", "newer", "none", "new", "four"}
    writer.upsert_partition(spark, path, spark.createDataFrame([(3, 2, "changed")], schema), ["event_id"])
    assert values() == {"early", "newer", "none", "changed", "four"}
    assert layout.prune(spark, path) > 0 and layout.prune(spark, path) == 0
    assert values() == {"early", "newer", "none", "changed", "four"}
    assert writer.compact(spark, f"file://{tmp_path}/nothing") == 0


def test_small_files_without_ids_are_merged(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    for i in range(5):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(path)
    assert len(layout.data_files(spark, path)) == 5
    assert writer.compact(spark, path, most_files=3) == 50 and len(layout.data_files(spark, path)) == 3
    assert writer.compact(spark, path) == 50 and len(layout.data_files(spark, path)) == 1
    assert sorted(r["id"] for r in reader.read_unified(spark, path).collect()) == list(range(50))


def test_two_partitions_are_compacted_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    paths = [f"file://{tmp_path}/t/dt=2024-01-0{i}" for i in range(1, 5)]
    for n, path in enumerate(paths):
        for i in range(3):
            spark.createDataFrame([(i, n, f"{n}-{i}")], "event_id int, ts_ingest int, v string").write.mode("append").parquet(path)
    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(lambda p: writer.compact(spark, p), paths)) == [3] * 4
    found = {(r["dt"], r["v"]) for r in reader.read_unified(spark, f"file://{tmp_path}/t").collect()}
    assert found == {(f"2024-01-0{n + 1}", f"{n}-{i}") for n in range(4) for i in range(3)}


def test_of_two_writers_of_a_partition_one_fails_and_nothing_is_lost(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/p"
    spark.range(10).write.parquet(path)
    files = layout.data_files(spark, path)
    create = layout.Store.create

    def overtaken(self, where, text, overwrite=False):
        monkeypatch.setattr(layout.Store, "create", create)
        layout.publish(spark.range(3), path, files)  # another writer, just before the manifest
        return create(self, where, text, overwrite)

    monkeypatch.setattr(layout.Store, "create", overtaken)
    with pytest.raises(layout.PublishError):
        layout.publish(spark.range(5), path, files)
    assert reader.read_unified(spark, path).count() == 3

    def broken(self, where, text, overwrite=False):
        raise RuntimeError("lost")

    monkeypatch.setattr(layout.Store, "create", broken)
    with pytest.raises(RuntimeError):
        layout.publish(spark.range(7), path, files)
    assert reader.read_unified(spark, path).count() == 3  # a failed publication changes nothing


def test_only_wanted_days_are_listed(spark, tmp_path, monkeypatch):
    for day in range(1, 6):
        spark.range(day).write.parquet(f"{tmp_path}/t/dt=2024-01-0{day}")
    listed = []
    children = layout.Store.children
    monkeypatch.setattr(layout.Store, "children", lambda self, p: listed.append(p) or children(self, p))
    assert reader.read_unified(spark, f"file://{tmp_path}/t", "2024-01-02", "2024-01-03").count() == 5
    assert [p.rsplit("/", 1)[-1] for p in listed] == ["t", "dt=2024-01-03", "dt=2024-01-02"]


def test_a_gold_write_that_fails_leaves_nothing(spark, tmp_path):
    root = f"file://{tmp_path}"
    good = bars(spark, [row(0)])
    assert writer.write_gold(good, root, "d", "p", "1.0.0") == 1
    for bad in (good.withColumn("ts_available", F.lit(None).cast("timestamp_ntz")), good.withColumn("instrument_key", F.lit(None).cast("string")), bars(spark, [row(1), row(2, late=-1)])):
        with pytest.raises(writer.LeakageError):
            writer.write_gold(bad, root, "d", "p", "1.0.0")
    assert writer.write_gold(good.limit(0), root, "d", "p", "1.0.0") == 0
    assert reader.Lake(spark, root).gold("d", "p").count() == 1
    with pytest.raises(reader.ReadError):
        lake = reader.Lake(spark, root)
        good.withColumnRenamed("ts_event", "ts_label").write.parquet(f"{root}/gold/dataset=l/project=p/version=v1")
        lake.gold("l", "p", time_range=(BASE, BASE), prune_by_dt=True)


def test_damaged_gzip_files(spark, tmp_path):
    lines = "".join(f'{{"event_id":"e{i}"}}\n' for i in range(2000)).encode()
    whole = gzip.compress(lines)
    (tmp_path / "a.gz").write_bytes(whole + gzip.compress(b'{"event_id":"more"}\n'))  # two members
    (tmp_path / "b.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "c.gz").write_bytes(whole[:-6] + b"xx" + whole[-4:])
    (tmp_path / "d.gz").write_bytes(whole)
    counts = {r["file"][-4]: r["count"] for r in reader.salvaged_lines(spark, f"file://{tmp_path}").groupBy("file").count().collect()}
    assert counts["a"] == 2001 and counts["d"] == 2000 and 0 < counts["b"] < 2000 and "c" not in counts
    good, bad = reader.bronze(spark, f"file://{tmp_path}", "event_id string", salvage=True)
    assert bad.count() == 0 and good.where("event_id IS NULL").count() == 0
    (tmp_path / "d.gz").unlink()
    with pytest.raises(reader.ReadError):
        reader.salvaged_lines(spark, f"file://{tmp_path}")


def test_bronze_and_vendor_files(spark, tmp_path):
    with gzip.open(tmp_path / "a.json.gz", "wt") as f:
        f.write('{"event_id":"a"}\nnot json\n{"event_id":"b"}\n')
    good, bad = reader.bronze(spark, str(tmp_path / "a.json.gz"), "event_id string")
    assert good.count() == 2 and bad.count() == 1
    csv = tmp_path / "b.csv"
    csv.write_text("ticker,volume,open,close,high,low,window_start,transactions\nA,1,1,1,1,1,1700000000000000000,3\n")
    got = reader.vendor_csv(spark, str(csv)).first()
    assert got["ts_event"] == datetime(2023, 11, 14, 22, 13, 20)
    csv.write_text(csv.read_text() + "A,x,1,1,1,1,1,3\n")
    with pytest.raises(Exception, match="1 rows rejected of 2"):
        reader.vendor_csv(spark, str(csv)).collect()


def test_filters_skip_what_they_do_not_know(spark):
    df = spark.range(5)
    assert reader.apply_filters(df, [("id", ">", 2), ("nope", "=", 1), ("id", "~", 1)]).count() == 2
    with pytest.raises(reader.ReadError):
        reader.require_columns(df, ["id", "x"], "d")
    assert reader.fingerprint(df) == reader.fingerprint(spark.range(1))


def envelope(i, minute=0, **more):
    at = f"2024-01-01T00:{minute:02d}:00Z"
    return {"event_id": f"e{i}", "provider": "p", "feed": "bars", "instrument_key": "equity:A", "ts_event": at, "ts_ingest": at} | more


def test_stream_ingest_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [json.dumps(envelope(i, i % 50)) for i in range(40)] + [json.dumps(envelope(i, 55)) for i in range(10)]
    lines += ["nonsense", json.dumps(envelope(99, ts_event="2030-01-01T00:00:00Z")), json.dumps(envelope(98, feed=None))]
    (folder / "1.json").write_text("\n".join(lines))
    stream = spark.readStream.text(str(folder))
    root = str(tmp_path / "out")
    query = ingest.run(stream, root, now="2024-01-02 00:00:00")
    query.awaitTermination(120)
    silver = spark.read.parquet(f"{root}/silver")
    assert silver.count() == 40 and silver.select("event_id").distinct().count() == 40
    assert silver.where("ts_available < ts_event").count() == 0
    errors = {r["error"]: r["count"] for r in spark.read.parquet(f"{root}/errors").groupBy("error").count().collect()}
    assert errors == {"bad_json": 1, "future_event": 1, "missing_feed": 1}
    again = ingest.run(spark.readStream.text(str(folder)), root, now="2024-01-02 00:00:00")
    again.awaitTermination(120)
    assert spark.read.parquet(f"{root}/silver").count() == 40


def test_late_and_repeated_events_of_a_stream(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    late = "2023-12-25T00:00:00Z"
    files = [
        [json.dumps(envelope(1)), json.dumps(envelope(2)), json.dumps(envelope(2, 0))],
        [json.dumps(envelope(3, 59)), json.dumps(envelope(1, 0)), json.dumps(envelope(4, ts_event=late, ts_ingest=late))],  # a repeated and a very late event
        ["nonsense", json.dumps(envelope(4, ts_event=late, ts_ingest=late)), json.dumps(envelope(5, ts_event=late))],
    ]
    for n, lines in enumerate(files):
        (folder / f"{n}.json").write_text("\n".join(lines))
        ingest.run(spark.readStream.text(str(folder)), root, now="2024-01-02 00:00:00").awaitTermination(120)
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{root}/silver").collect()) == ["e1", "e2", "e3", "e4", "e5"]
    assert spark.read.text(f"{root}/bronze").count() == 9  # every line, repeated ones too
    batch = ingest.parse(spark.createDataFrame([(x,) for x in files[2]], "value string"), "2024-01-02 00:00:00")
    ingest.write_layers(root)(batch, 2)  # a batch that is run again
    assert spark.read.parquet(f"{root}/silver").count() == 5 and spark.read.text(f"{root}/bronze").count() == 9
    mended = ingest.reprocess(spark, root, "again", "2024-01-02 00:00:00", repair=lambda df: df.select(F.lit(json.dumps(envelope(6))).alias("value")))
    assert mended == {"read": 1, "recovered": 1, "failed": 0} and spark.read.parquet(f"{root}/silver").count() == 6
    assert ingest.reprocess(spark, root, "again", "2024-01-02 00:00:00")["failed"] == 1
    assert ingest.purge(spark, root, 99) == 3


def test_a_watch_whose_window_is_over_expires_once(spark, tmp_path):
    folder = tmp_path / "w"
    schema = "alert_id long, ts timestamp, seq int, price double, is_call boolean, window_end timestamp"
    end, write = BASE + timedelta(hours=1), lambda rows, n: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{n}")
    write([(9, BASE + timedelta(days=2), 0, 1.0, True, BASE + timedelta(days=9))], 1)  # moves the watermark on
    write([(1, BASE + timedelta(days=2), 0, 100.0, True, BASE + timedelta(days=1, hours=20)), (2, BASE + timedelta(days=2), 1, 5.0, True, BASE + timedelta(days=2, hours=1)), (9, BASE + timedelta(days=3), 1, 1.0, True, BASE + timedelta(days=9))], 2)
    write([(9, BASE + timedelta(days=4), 2, 1.01, True, BASE + timedelta(days=9))], 3)
    write([(9, BASE + timedelta(days=5), 3, 1.01, True, BASE + timedelta(days=9)), (2, BASE + timedelta(days=4, hours=23), 2, 50.0, True, BASE + timedelta(days=2, hours=1))], 4)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))
    out = watch.watch(stream, 0.1, 0.1).writeStream.format("memory").queryName("expired").option("checkpointLocation", str(tmp_path / "c"))
    out.trigger(availableNow=True).start().awaitTermination(180)
    assert [(r["alert_id"], r["outcome"]) for r in spark.table("expired").collect()] == [(2, "expired")]
    del end


def test_errors_that_may_go_away_are_tried_again():
    seen = []

    def work():
        seen.append(1)
        if len(seen) < 3:
            raise TimeoutError("timed out")
        return "done"

    assert control.tried(work, sleep=lambda s: None) == "done" and len(seen) == 3
    with pytest.raises(ValueError):
        control.tried(lambda: (_ for _ in ()).throw(ValueError("bad_json")), sleep=lambda s: None)
    assert [round(control.delay(n, draw=lambda: 0.5), 2) for n in (0, 1, 2, 20)] == [0.1, 0.2, 0.4, 30.0]
    assert control.retryable("503 Service Unavailable") and not control.retryable("missing_feed")
    assert control.Pressure(61_000).slow_down and not control.Pressure(59_000).slow_down
    assert control.pressure({"sources": [{"metrics": {"avgOffsetsBehindLatest": "100"}}], "processedRowsPerSecond": 1.0}).slow_down
    assert control.cadence("swing") < control.cadence(None)


def test_stream_watch(spark, tmp_path):
    folder = tmp_path / "w"
    prices = [(1, 0, 100.0), (1, 1, 104.0), (1, 2, 111.0), (2, 0, 100.0), (2, 1, 88.0), (3, 0, 100.0), (3, 1, 101.0), (4, 0, 50.0)]
    rows = [(a, BASE + timedelta(minutes=m), m, p, a != 4, BASE + timedelta(minutes=30)) for a, m, p in prices]
    rows.append((4, BASE + timedelta(minutes=5), 5, 40.0, False, BASE + timedelta(minutes=30)))
    schema = "alert_id long, ts timestamp, seq int, price double, is_call boolean, window_end timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/1")
    far = spark.createDataFrame([(9, BASE + timedelta(days=2), 0, 1.0, True, BASE + timedelta(days=3))], schema)
    far.coalesce(1).write.parquet(f"{folder}/2")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))
    out = watch.watch(stream, 0.1, 0.1).writeStream.format("memory").queryName("outcomes").option("checkpointLocation", str(tmp_path / "c"))
    out.trigger(availableNow=True).start().awaitTermination(180)
    got = {r["alert_id"]: r["outcome"] for r in spark.table("outcomes").collect()}
    assert got[1] == "hit_tp" and got[2] == "hit_sl" and got[4] == "hit_tp"
    assert got.get(3, "expired") == "expired"


def test_stream_windows_equal_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "e"))
    counted = lambda df: df.groupBy(F.window("ts", "1 hour"), "event_type").count()
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    query = counted(stream).writeStream.outputMode("complete").format("memory").queryName("hours").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(map(tuple, spark.table("hours").select("window.start", "event_type", "count").collect())) == sorted(map(tuple, counted(events).select("window.start", "event_type", "count").collect()))


