import os

from pyspark.sql import functions as F

from cueloom.operators import cues
from cueloom.sources import listing
from cueloom.streaming import incremental
from cueloom.streaming.incremental import append_new_cues, file_status

SRT = (
    "﻿1\r\n00:00:01,000 --> 00:00:02,500\r\nFirst line\r\nsecond <i>line</i>\r\n\r\n"
    "00:00:03.000 --> 00:00:04.000 X1:1 X2:2\r\nno index\r\n \r\n"
    "3\r\nnot a time\r\nlost\r\n\r\n\r\n"
    "4\r\n00:00:09,000 --> 00:00:08,000\r\ninverted\r\n\r\n"
    "5\r\n01:00:00,001 --> 01:00:00,002\r\n\r\n"
)
VTT = (
    "WEBVTT Kind: captions\nX: y\n\nNOTE a note\n00:01.000 --> 00:02.000\n\nSTYLE\n::cue {}\n\n"
    "intro\n00:01.000 --> 00:02.500 align:start\n<v Ann>Hi <b>you</b>\nthere\n\n"
    "01:00:00.250 --> 01:00:01.000\nlater\n\n"
    "broken --> 00:00\nx\n"
)


def files(spark):
    rows = [("d/a.srt", SRT), ("d/b.vtt", VTT), ("d/c.txt", "plain"), ("d/e.srt", ""), ("d/f.srt", "\r\n\r\n")]
    return spark.createDataFrame(rows, "path string, body string")


def test_srt(spark):
    found = cues.srt_cues(files(spark).where("path = 'd/a.srt'")).orderBy("cue_no").collect()
    assert [tuple(r)[1:] for r in found] == [
        (1, 1000, 2500, "First line\nsecond <i>line</i>"),
        (2, 3000, 4000, "no index"),
        (3, 9000, 8000, "inverted"),
        (4, 3600001, 3600002, ""),
    ]


def test_vtt(spark):
    found = cues.vtt_cues(files(spark).where("path = 'd/b.vtt'")).orderBy("cue_no").collect()
    assert [tuple(r)[1:] for r in found] == [
        (1, 1000, 2500, "Hi you\nthere"),
        (2, 3600250, 3601000, "later"),
    ]


def test_mixed_files_and_rejects(spark):
    named = cues.clip_ids(cues.all_cues(files(spark)))
    assert {r.clip_id for r in named.collect()} == {"a_1", "a_2", "a_3", "a_4", "b_1", "b_2"}
    status = {r.path: (r.status, r.blocks) for r in cues.rejected_blocks(files(spark)).collect()}
    assert status == {
        "d/a.srt": ("bad_blocks", 1),
        "d/b.vtt": ("bad_blocks", 1),
        "d/c.txt": ("unsupported", 0),
        "d/e.srt": ("parsed", 0),
        "d/f.srt": ("parsed", 0),
    }


def test_numbers_follow_the_file_for_any_number_of_cues(spark):
    body = "\n\n".join(f"{i}\n00:00:{i % 60:02d},000 --> 00:00:{i % 60:02d},500\nt{i}" for i in range(1, 2001))
    found = cues.srt_cues(spark.createDataFrame([("a.srt", body)], "path string, body string"))
    assert found.where(F.col("text") != F.concat(F.lit("t"), "cue_no")).count() == 0
    assert found.count() == 2000


def test_long_runs_of_blank_lines(spark):
    cue = "00:00:01,000 --> 00:00:02,000\nx"
    body = "\n" * 100_000 + cue + "\n" + " \n" * 100_000 + cue + "\n" * 100_000
    assert cues.srt_cues(spark.createDataFrame([("a.srt", body)], "path string, body string")).count() == 2


def test_done_clips_are_skipped_by_recording(spark):
    found = cues.srt_cues(files(spark).where("path = 'd/a.srt'"))
    done = spark.createDataFrame([("d/a.srt", 1), ("other/a.srt", 2)], "path string, cue_no long")
    left = cues.skip_done_clips(found, done, ["path", "cue_no"])
    assert sorted(r.cue_no for r in left.collect()) == [2, 3, 4]


def test_stream_reads_new_files_and_tells_the_status_of_each(spark, tmp_path):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run(files):
        for name, body in files.items():
            (root / name).parent.mkdir(parents=True, exist_ok=True)
            (root / name).write_bytes(body)
        append_new_cues(spark, str(root), out, state).awaitTermination()
        rows = file_status(spark.read.parquet(out)).collect()
        return {r.path.split("/in/")[1]: (r.status, r.blocks, r.cues) for r in rows}

    good = b"1\n00:00:01,000 --> 00:00:02,000\nhi\n"
    first = run({"a/one.srt": good, "b/one.srt": good + b"\nno cue\n", "empty.vtt": b"\n", "notes.txt": b"x"})
    assert first == {
        "a/one.srt": ("parsed", 0, 1),
        "b/one.srt": ("bad_blocks", 1, 1),
        "empty.vtt": ("no_cue", 0, 0),
        "notes.txt": ("unsupported", 0, 0),
    }
    assert run({}) == first
    second = run({"c/two%20.vtt": b"WEBVTT\n\n00:01.000 --> 00:02.500\nhello\n\xff\n"})
    assert second == first | {"c/two%20.vtt": ("parsed", 0, 1)}
    rows = {r.clip_id: (r.start_ms, r.end_ms) for r in spark.read.parquet(out).collect()}
    assert rows == {"one_1": (1000, 2000), "two%20_1": (1000, 2500), None: (None, None)}


def test_files_without_cues_keep_a_row(spark):
    rows = [("a.srt", None), ("b.srt", "junk"), ("c.txt", None), ("d.vtt", "WEBVTT\n")]
    files = spark.createDataFrame(rows, "path string, body string")
    found = {r.path: (r.status, r.blocks, r.cue_no) for r in cues.cues_and_status(files).collect()}
    assert found == {
        "a.srt": ("unreadable", 0, None), "b.srt": ("no_cue", 1, None), "c.txt": ("unsupported", 0, None), "d.vtt": ("no_cue", 0, None)
    }


def test_a_file_is_judged_once_not_once_a_cue(spark, capsys):
    cues.cues_and_status(files(spark)).explain()
    by_row, by_file = capsys.readouterr().out.split("Generate", 1)
    assert "WEBVTT" not in by_row and "WEBVTT" in by_file


def test_a_batch_of_many_files_is_listed_and_read_in_few_tasks(spark, tmp_path):
    root, count = tmp_path / "in", 300
    root.mkdir()
    for i in range(count):
        (root / f"{i}.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\nhi\n")
    before = spark.conf.getAll
    query = append_new_cues(spark, str(root), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).select("path").distinct().count() == count
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(j).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.getAll == before


GOOD = b"1\n00:00:01,000 --> 00:00:02,000\nhi\n"


def streamed(spark, tmp_path, root=None):
    """All rows after one more run over ``in``."""
    at = [str(tmp_path / name) for name in ("in", "out", "state")]
    append_new_cues(spark, root or at[0], *at[1:]).awaitTermination()
    return sorted(map(repr, spark.read.parquet(at[1]).collect()))


def written(tmp_path, files):
    for name, body in files.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(body)


def source_log(tmp_path):
    """What the driver keeps of a stream's source: an entry a line, below a version."""
    logs = [p for p in (tmp_path / "state" / "sources" / "0").iterdir() if not p.name.startswith(".")]
    return [line for p in logs for line in p.read_text().splitlines()[1:]]


def test_the_driver_keeps_a_line_a_batch_not_a_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "FILES_PER_TRIGGER", 100)
    written(tmp_path, {f"{i % 7}/{i}.srt": GOOD for i in range(300)})
    assert len(streamed(spark, tmp_path)) == 300
    assert len(source_log(tmp_path)) == 3
    written(tmp_path, {f"{i % 7}/{i}.srt": GOOD for i in range(250, 350)})
    rows = streamed(spark, tmp_path)
    assert len(rows) == len(set(rows)) == 350 and len(source_log(tmp_path)) == 4
    assert streamed(spark, tmp_path) == rows


def test_the_stream_reads_what_a_file_source_reads(spark, tmp_path, monkeypatch):
    names = (
        "a/b c%20+.srt", "ü/ö.srt", "x#y.srt", "q?r.srt", "new\nline.srt", "{x}.srt", ".hid.srt", "_hid.srt", "_k=v/_k=w.srt",
        "_hidden/z.srt", ".dot/z.srt", "half.srt._COPYING_", "_metadata/m.srt", "_metadata.srt", "UP.SRT", "deep/1/2/3.vtt",
    )
    written(tmp_path, dict.fromkeys(names, GOOD) | {"empty.srt": b"", "blank.srt": b"\n", "bad.srt": b"\xff\x00junk"})
    root = os.fsencode(tmp_path / "in")
    os.symlink(root + b"/a", root + b"/folder")
    os.symlink(root + b"/gone.srt", root + b"/broken.srt")
    os.mkfifo(root + b"/pipe.srt")
    with open(root + b"/\xff.srt", "wb") as file:
        file.write(GOOD)
    found = streamed(spark, tmp_path)
    assert len(found) == 13 and (tmp_path / "state" / "listed").is_dir()
    for root in (f"file://{tmp_path}/in", f"{tmp_path}//in/", f"{tmp_path}/i*"):
        (tmp_path / "other" / str(len(root))).mkdir(parents=True)
        assert streamed(spark, tmp_path / "other" / str(len(root)), root) == found
    monkeypatch.setattr(incremental, "read_by_workers", lambda spark, root: False)
    (tmp_path / "plain").mkdir()
    assert streamed(spark, tmp_path / "plain", f"{tmp_path}/in") == found


def test_a_checkpoint_goes_on_as_it_was_begun(spark, tmp_path, monkeypatch):
    written(tmp_path, {"a.srt": GOOD, "b.srt": GOOD})
    with monkeypatch.context() as only:
        only.setattr(incremental, "read_by_workers", lambda spark, root: False)
        assert len(streamed(spark, tmp_path)) == 2
    written(tmp_path, {"c.srt": GOOD})
    assert len(streamed(spark, tmp_path)) == 3 and not (tmp_path / "state" / "listed").exists()


def test_files_listed_by_a_run_that_broke_off_are_read_once(spark, tmp_path):
    root, listed = str(tmp_path / "in"), str(tmp_path / "state" / "listed")
    written(tmp_path, {"a.srt": GOOD, "b.srt": GOOD, "gone.srt": GOOD, "c/d.srt": GOOD})
    some = listing.list_files(spark, root).where(~F.col("path").endswith("/b.srt"))
    some.repartition(2).write.parquet(listed)
    (tmp_path / "in" / "gone.srt").unlink()
    rows = streamed(spark, tmp_path)
    assert [r.split("/in/")[1].split("'")[0] for r in rows] == ["a.srt", "b.srt", "c/d.srt"]
    assert streamed(spark, tmp_path) == rows


def test_contents_of_many_bytes_are_read_whole(spark, tmp_path):
    sizes = {f"{i}.txt": 1 + i * 3_000_000 for i in range(6)} | {"large.txt": 20_000_000}
    written(tmp_path, {name: b"x" * size for name, size in sizes.items()})
    found = listing.read_files(listing.list_files(spark, str(tmp_path / "in")).coalesce(1))
    lengths = found.select(F.substring_index("path", "/", -1), F.length("content")).collect()
    assert sorted(map(tuple, lengths)) == sorted(sizes.items())
