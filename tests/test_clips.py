from cueloom.plans import clips

SRT = "1\n00:00:00,500 --> 00:00:01,000\none\n\n2\n00:00:01,000 --> 00:00:09,000\ntwo\nlines\n"


def inputs(spark):
    manifest = spark.createDataFrame(
        [(1, "a.mp4", "a.srt", "en"), (2, "a.mp4", "a.srt", "en"), (3, "b.wav", "b.srt", "fi"), (4, None, "a.srt", "en")],
        "manifest_id long, media_file string, transcript_file string, language string",
    )
    texts = spark.createDataFrame([("t/a.srt", SRT), ("t/b.srt", SRT), ("t/c.srt", SRT)], "path string, body string")
    audio = spark.createDataFrame([("m/a.wav",)], "path string")
    frames = spark.createDataFrame(
        [("a.wav", k, 500, 4, 2, [float(4 * k + i) for i in range(4)]) for k in range(4)],
        "audio_id string, frame_no long, frame_ms int, sample_rate int, channels int, samples array<float>",
    )
    return manifest, audio, texts, frames


def test_manifest_to_clips(spark):
    manifest, audio, texts, frames = inputs(spark)
    cues = clips.manifest_cues(manifest, audio, texts)
    got = {r.clip_id: (r.language, r.text, list(r.samples)) for r in clips.cut_clips(frames, cues).collect()}
    assert cues.count() == len(got) == 2
    assert got == {"a_1": ("en", "one", [4.5, 6.5]), "a_2": ("en", "two\nlines", [8.5, 10.5, 12.5, 14.5])}
    left = clips.manifest_cues(manifest, audio, texts, done=cues.where("cue_no = 1"))
    assert [r.clip_id for r in left.collect()] == ["a_2"]


def test_clips_to_dataset(spark):
    media = spark.createDataFrame([("en", "m/a%20b.wav"), ("en", "m/none.wav"), ("fi", "m/a b.wav")], "language string, path string")
    texts = spark.createDataFrame([("en", "t/a b.txt", " one\r\ntwo "), ("fi", "t/a%20b.txt", "x")], "language string, path string, body string")
    got = sorted((r.language, r.audio.path, r.audio.sample_rate, r.sentence) for r in clips.paired_dataset(media, texts).collect())
    assert got == [("en", "m/a%20b.wav", 16000, "one two"), ("fi", "m/a b.wav", 16000, "x")]


def test_transcripts_of_one_name_in_two_folders_give_one_cue_each(spark):
    manifest, audio, texts, _ = inputs(spark)
    other = spark.createDataFrame([("s/a.srt", "1\n00:00:00,000 --> 00:00:01,000\nother\n")], "path string, body string")
    cues = clips.manifest_cues(manifest, audio, texts.union(other)).collect()
    assert [(r.clip_id, r.text) for r in cues] == [("a_1", "other")]
