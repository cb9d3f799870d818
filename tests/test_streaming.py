import json

from tableprofile.operators.quality import PROFILE_SCHEMA, score_profiles
from tableprofile.streaming.scoring import read_profile_stream, rejected_stream, scored_stream, write_scores

ROWS = [
    {"n_rows": 10000, "n_cols": 10, "max_missing_share": 0.1, "numeric_cols": 3, "categorical_cols": 4, "name": "good"},
    {"n_rows": 10, "n_cols": 200, "max_missing_share": 1.0, "numeric_cols": 0, "categorical_cols": 5, "name": "bad"},
    {"n_rows": -1, "n_cols": 1, "max_missing_share": 0.0, "numeric_cols": 1, "categorical_cols": 0, "name": "invalid"},
]


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_stream_equals_batch(spark, tmp_path):
    inbox = tmp_path / "in"
    drop(inbox, "1.json", ROWS[:1])
    stream = read_profile_stream(spark, str(inbox), extra="name string")
    assert stream.isStreaming
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    write_scores(scored_stream(stream), out, progress).awaitTermination()
    drop(inbox, "2.json", ROWS[1:])
    write_scores(scored_stream(stream), out, progress).awaitTermination()
    streamed = {r["name"]: r["quality_score"] for r in spark.read.parquet(out).collect()}
    batch = score_profiles(spark.read.schema(PROFILE_SCHEMA + ", name string").json(str(inbox))).where("name <> 'invalid'")
    assert streamed == {r["name"]: r["quality_score"] for r in batch.collect()}
    assert streamed == {"good": 0.9, "bad": 0.0}


def test_rejected_profiles(spark, tmp_path):
    inbox = tmp_path / "in"
    drop(inbox, "1.json", ROWS)
    stream = rejected_stream(read_profile_stream(spark, str(inbox), extra="name string"))
    query = stream.writeStream.format("memory").queryName("rejected").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r["name"] for r in spark.sql("SELECT name FROM rejected").collect()] == ["invalid"]


def dropped(folder, name, rows):
    folder.mkdir(exist_ok=True)
    fields = ["table_name", "profiled_at", "n_rows", "n_cols", "max_missing_share", "numeric_cols", "categorical_cols"]
    (folder / name).write_text("".join(json.dumps(dict(zip(fields, r))) + "\n" for r in rows))


def test_one_verdict_per_table(spark, tmp_path):
    """Late, repeated and rejected profiles, restarts in between, and state that goes with the watermark."""
    from tableprofile.streaming import verdicts as V

    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        profiles = spark.readStream.schema(V.DATED_SCHEMA).json(str(source))
        query = V.write_verdicts(V.newest_profiles(profiles, forget_seconds=10 * 86400), out, checkpoint)
        query.awaitTermination()
        assert query.exception() is None
        return {r["table_name"]: (r["profiled_at"].strftime("%d %H"), r["n_rows"], r["ok_for_model"]) for r in V.current_verdicts(spark, out).collect()}

    dropped(source, "1.json", [("a", "2024-05-02T10:00:00Z", 2000, 5, 0.0, 2, 2), ("b", "2024-05-02T05:00:00Z", 2000, 5, 0.9, 2, 2), ("a", "2024-05-02T09:00:00Z", 10, 5, 0.0, 2, 2)])
    assert run() == {"a": ("02 10", 2000, True), "b": ("02 05", 2000, False)}
    # After a restart: an older profile of a, the same one again, a newer one of b, and one outside the ranges.
    dropped(source, "2.json", [("a", "2024-05-02T07:00:00Z", 1, 5, 0.0, 2, 2), ("a", "2024-05-02T10:00:00Z", 2000, 5, 0.0, 2, 2), ("b", "2024-05-02T09:00:00Z", 3000, 5, 0.1, 2, 2), ("b", "2024-05-02T12:00:00Z", 5000, 5, 1.5, 2, 2)])
    assert run() == {"a": ("02 10", 2000, True), "b": ("02 09", 3000, True)}
    changes = spark.read.parquet(out).groupBy("table_name").count().collect()
    assert {r["table_name"]: r["count"] for r in changes} == {"a": 1, "b": 2}
    # Twenty days on; a profile from before the watermark no longer counts.
    dropped(source, "3.json", [("c", "2024-05-22T10:00:00Z", 2000, 5, 0.0, 2, 2)])
    assert run()["c"] == ("22 10", 2000, True)
    dropped(source, "4.json", [("a", "2024-05-03T10:00:00Z", 7, 5, 0.0, 2, 2), ("c", "2024-05-22T09:00:00Z", 7, 5, 0.0, 2, 2)])
    assert run() == {"a": ("02 10", 2000, True), "b": ("02 09", 3000, True), "c": ("22 10", 2000, True)}
