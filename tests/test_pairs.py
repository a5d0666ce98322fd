import pytest
from pyspark.sql import functions as F

from cueloom.errors import AlignmentError
from cueloom.operators import ordering, pairs
from cueloom.sources import lines


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def test_pairing_decodes_each_side_its_way(spark):
    media = paths(spark, "m/a%20b.wav", "m/c.d.wav", "m/alone.wav", "m/x%2Ey.wav", "m/a%20b.mp3")
    texts = paths(spark, "t/a b.txt", "t/a%20b.srt", "t/c.d.txt", "t/x.y.txt", "t/unused.txt")
    found = {r.media_path: r.transcript_path for r in pairs.pair_clips(media, texts).collect()}
    assert found == {
        "m/a%20b.wav": "t/a b.txt",
        "m/a%20b.mp3": "t/a b.txt",
        "m/c.d.wav": "t/c.d.txt",
        "m/x%2Ey.wav": "t/x.y.txt",
    }
    assert [r.media_path for r in pairs.unpaired_media(media, texts).collect()] == ["m/alone.wav"]


def test_pairing_stays_within_a_language(spark):
    media = spark.createDataFrame([("en", "m/a.wav"), ("fi", "m/a.wav")], "language string, path string")
    texts = spark.createDataFrame([("fi", "t/a.txt")], "language string, path string")
    found = pairs.pair_clips(media, texts, ["language"]).collect()
    assert [r.language for r in found] == ["fi"]


def write(path, content):
    path.write_bytes(content)
    return str(path)


def test_lines_keep_blanks_and_drop_the_last_newline(spark, tmp_path):
    path = write(tmp_path / "a.txt", b"one\n\nthree \r\nfour\n\n")
    got = lines.read_lines(spark, path).orderBy("line_no").collect()
    assert [(r.line_no, r.value) for r in got] == [(0, "one"), (1, ""), (2, "three "), (3, "four"), (4, "")]
    assert lines.read_lines(spark, write(tmp_path / "none.txt", b"")).count() == 0


def test_line_numbers_survive_splits_and_part_files(spark, tmp_path):
    (tmp_path / "list").mkdir()
    expected = [f"{i} {'x' * (i % 97)}" for i in range(5000)]
    for part, start in enumerate(range(0, 5000, 1250)):
        body = "".join(line + "\n" for line in expected[start : start + 1250])
        write(tmp_path / "list" / f"part-{part}.txt", body.encode())
    conf = {"spark.sql.files.maxPartitionBytes": "10000", "spark.sql.files.openCostInBytes": "0"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        frame = lines.read_lines(spark, str(tmp_path / "list"))
        assert spark.read.text(str(tmp_path / "list")).rdd.getNumPartitions() > 8
        got = {r.line_no: r.value for r in frame.collect()}
    finally:
        for key in conf:
            spark.conf.unset(key)
    assert [got[i] for i in range(5000)] == expected and len(got) == 5000


def test_zip_refuses_unequal_lists(spark, tmp_path):
    left = lines.read_lines(spark, write(tmp_path / "l", b"a\nb\n"))
    right = lines.read_lines(spark, write(tmp_path / "r", b"x\ny\n"))
    got = pairs.zip_lines(left, right).orderBy("line_no").collect()
    assert [tuple(r) for r in got] == [(0, "a", "x"), (1, "b", "y")]
    with pytest.raises(AlignmentError):
        pairs.zip_lines(left, lines.read_lines(spark, write(tmp_path / "s", b"x\n")))


def test_lists_written_together_stay_aligned(spark, tmp_path):
    rows = spark.range(3000).select(
        (F.col("id") % 3).cast("string").alias("language"),
        F.md5(F.col("id").cast("string")).alias("key"),
        F.concat(F.lit("m"), "id").alias("media"),
        F.concat(F.lit("t"), "id").alias("text"),
    )
    lines.write_pair_lists(rows.repartition(11), str(tmp_path), ["0", "1"], ["key"], "media", "text")
    for language in ("0", "1"):
        media, text = (lines.read_lines(spark, lines.list_path(tmp_path, kind, language)) for kind in ("media", "transcription"))
        zipped = pairs.zip_lines(media, text)
        assert zipped.count() == 1000
        assert zipped.where("substr(media, 2) <> substr(sentence, 2)").count() == 0


def hot(spark, n=20_000):
    """One language holds nearly all rows."""
    return spark.range(n).select(
        F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("language"),
        F.md5(F.col("id").cast("string")).alias("key"),
    )


def test_positions_are_dense_per_group(spark):
    rows = hot(spark).withColumn("language", F.when(F.col("language") != "rare", F.col("language")))
    got = ordering.with_position(rows.repartition(5), ["key"], "language")
    by_language = {}
    for r in got.collect():
        by_language.setdefault(r.language, []).append((r.position, r.key))
    assert {k: len(v) for k, v in by_language.items()} == {None: 400, "hot": 19_600}
    for rows in by_language.values():
        rows.sort()
        assert [p for p, _ in rows] == list(range(len(rows)))
        assert [k for _, k in rows] == sorted(k for _, k in rows)


def test_progress_rows(spark):
    sample = pairs.progress_sample(hot(spark), ["key"])
    counts = {r.language: r["count"] for r in sample.groupBy("language").count().collect()}
    assert counts == {"rare": 4, "hot": 196}


def test_shuffle_is_a_stable_permutation(spark):
    rows = hot(spark, 4000)
    first = {r.key: r.position for r in ordering.seeded_shuffle(rows, ["key"], 22).collect()}
    again = {r.key: r.position for r in ordering.seeded_shuffle(rows.repartition(13), ["key"], 22).collect()}
    other = {r.key: r.position for r in ordering.seeded_shuffle(rows, ["key"], 23).collect()}
    assert first == again != other
    assert sorted(first.values()) == list(range(4000))


def test_one_stem_may_own_most_files(spark):
    ids = spark.range(9000)
    media, texts = (
        ids.selectExpr(f"concat('{side}', id, if(id % 3 = 0, '/all', concat('/c', id)), '{ending}') as path")
        for side, ending in (("m", ".wav"), ("t", ".txt"))
    )
    found = pairs.pair_clips(media, texts)
    assert found.count() == 9000
    shared = found.where("media_path like '%/all.wav'").select("transcript_path").distinct().collect()
    assert [r.transcript_path for r in shared] == ["t0/all.txt"]


def test_audio_exists(spark):
    rows = spark.createDataFrame([("a.wav", 1), ("b.wav", 2)], "audio_path string, n int")
    assert [r.n for r in pairs.audio_exists(rows, paths(spark, "b.wav", "b.wav")).collect()] == [2]


def test_lines_survive_other_splits(spark, tmp_path):
    """Reading in other splits after the call changes neither number nor count of lines."""
    path = write(tmp_path / "big", b"".join(b"line %d\n" % i for i in range(60_000)))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[1], "1024")
        spark.conf.set(keys[0], "200000")
        found = lines.read_lines(spark, path)
        spark.conf.set(keys[0], "70000")
        rows = found.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.line_no for r in rows) == list(range(60_000))
    assert all(r.value == f"line {r.line_no}" for r in rows)


def test_pair_lists_fold_line_breaks(spark, tmp_path):
    rows = spark.createDataFrame([("en", 1, "a.wav", "two\nlines"), ("en", 2, "b.wav", "x")], "language string, key int, media string, text string")
    lines.write_pair_lists(rows, str(tmp_path), ["en"], ["key"], "media", "text")
    assert [r.value for r in lines.read_lines(spark, lines.list_path(tmp_path, "transcription", "en")).orderBy("line_no").collect()] == ["two lines", "x"]
