"""The commands of the stages, chained over files on disk."""

from pyspark.sql import functions as F

from cueloom import jobs
from cueloom.runtime import clear_scratch, scratch_path


def test_stages_chain(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "session", lambda app: spark)
    monkeypatch.setattr(jobs, "clear_scratch", lambda spark: None)
    at = lambda name: str(tmp_path / name)
    run = lambda stage, *rest, **args: jobs.main([stage, *[x for k, v in args.items() for x in (f"--{k}", v)], *rest])
    for name in ("store/x/a.wav", "store/x/a.srt", "present/none.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("1\n00:00:00,500 --> 00:00:01,000\none\n\n2\n00:00:01,000 --> 00:00:09,000\ntwo\n")
    spark.createDataFrame(
        [("1", "a.wav", "a.srt", "en"), ("2", "gone.wav", "a.srt", "en")],
        "manifest_id string, media_file string, transcript_file string, language string",
    ).coalesce(1).write.option("header", True).csv(at("manifest"))
    run("listing", root=at("store"), out=at("listed.parquet"))
    run("plan", manifest=at("manifest"), objects=at("listed.parquet"), present=at("present"), out=at("plan"))
    plan = {r.media_file: r.status for r in spark.read.parquet(at("plan/plan")).collect()}
    assert plan == {"a.wav": "to_fetch", "gone.wav": "unresolved"}
    assert sum(r.n for r in spark.read.parquet(at("plan/summary")).collect()) == 2
    (tmp_path / "excluded.txt").write_text("nobody@x.org\nx/a.s\n")
    listed = {"exclude-list": at("excluded.txt")}
    run("plan", manifest=at("manifest"), objects=at("listed.parquet"), present=at("present"), out=at("other"), **listed)
    plan = {r.media_file: r.status for r in spark.read.parquet(at("other/plan")).collect()}
    assert plan == {"a.wav": "excluded", "gone.wav": "unresolved"}
    for _ in range(2):
        run("cues", subtitles=at("store"), out=at("cues"), state=at("state"))
    assert spark.read.parquet(at("cues")).where("status = 'parsed'").count() == 2
    frames = [("a.wav", k, 500, 4, 1, [float(2 * k + i) for i in range(2)]) for k in range(4)]
    spark.createDataFrame(
        frames, "audio_id string, frame_no long, frame_ms int, sample_rate int, channels int, samples array<float>"
    ).write.parquet(at("frames"))
    cut = {"manifest": at("manifest"), "audio": at("store"), "frames": at("frames"), "subtitles": at("store"), "out": at("clips")}
    for _ in range(2):
        run("clips", batch="first", **cut)
    run("clips", "--resume", batch="second", **cut)
    clips = {r.clip_id: (r.text, list(r.samples), r.batch) for r in spark.read.parquet(at("clips")).collect()}
    assert clips == {"a_1": ("one", [2.0, 3.0], "first"), "a_2": ("two", [4.0, 5.0, 6.0, 7.0], "first")}
    spark.createDataFrame([("en", "m/a.wav")], "language string, path string").write.parquet(at("media"))
    spark.createDataFrame([("en", "t/a.txt", "one two")], "language string, path string, body string").write.parquet(at("texts"))
    run("dataset", media=at("media"), transcripts=at("texts"), out=at("data"))
    assert [r.sentence for r in spark.read.parquet(at("data")).collect()] == ["one two"]
    pairs = [("a b c d", "a b x d", "a.wav", "en"), ("a", "", "b.wav", "en")]
    spark.createDataFrame(pairs, "reference string, hypothesis string, audio_path string, language string").write.parquet(at("pairs"))
    run("evaluate", pairs=at("pairs"), out=at("results"))
    assert {round(r.wer, 3) for r in spark.read.parquet(at("results/wer")).collect()} == {25.0}


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("cueloom.runtime.scratch_dir", lambda spark: str(tmp_path))
    spark.range(3).select(F.col("id")).write.parquet(scratch_path(spark, "x"))
    (tmp_path / "other").write_text("stays")
    clear_scratch(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]
