import json

from textloom.streaming import jobs

SCHEMA = "item string, at timestamp, status string, error string"


def events(path, name, rows):
    (path / name).write_text("\n".join(json.dumps(dict(zip(("item", "at", "status", "error"), r, strict=True))) for r in rows))


def test_windows_and_quarantine(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    events(source, "1.json", [("a", "2024-01-01T00:10:00Z", "error", "x"), ("a", "2024-01-01T00:20:00Z", "error", "y"), ("b", "2024-01-01T01:10:00Z", "ok", None)])
    events(source, "2.json", [("a", "2024-01-01T02:10:00Z", "error", "z")])
    counted = jobs.windowed_counts(jobs.event_stream(spark, str(source), SCHEMA), "at", ["status"])
    counted.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start().awaitTermination(120)
    assert sorted((r["status"], r["n"]) for r in spark.table("counted").collect()) == [("error", 1), ("error", 2), ("ok", 1)]
    bad = jobs.quarantined(jobs.event_stream(spark, str(source), SCHEMA), "item")
    bad.writeStream.format("memory").queryName("bad").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(120)
    assert [tuple(r)[:2] for r in spark.table("bad").collect()] == [("a", 3)]


def test_work_goes_on_where_it_stopped(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    run = lambda: jobs.process_new(jobs.event_stream(spark, str(source), SCHEMA), str(tmp_path / "done"), "item", lambda df: df.select("item"), str(tmp_path / "check")).awaitTermination(120)
    events(source, "1.json", [("a", None, "ok", None), ("a", None, "ok", None)])
    run()
    events(source, "2.json", [("a", None, "ok", None), ("b", None, "ok", None)])
    run()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "done")).collect()) == ["a", "b"]
