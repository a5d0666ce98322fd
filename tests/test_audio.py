import random

from pyspark.sql import functions as F

from cueloom.operators import audio

FRAMES = "audio_id long, frame_no long, frame_ms int, sample_rate int, channels int, samples array<float>"
CUES = "audio_id long, cue_no long, start_ms long, end_ms long"
RATE, FRAME_MS = 40, 500


def recording(spark, audio_id, n_samples, skip=()):
    size = RATE * FRAME_MS // 1000
    signal = [float(audio_id * 1000 + i) for i in range(n_samples)]
    rows = [
        (audio_id, k, FRAME_MS, RATE, 1, signal[k * size : (k + 1) * size])
        for k in range((n_samples + size - 1) // size)
        if k not in skip
    ]
    return signal, spark.createDataFrame(rows, FRAMES)


def clips(frames, cues, **options):
    cut = audio.cut_frames(frames, cues, **options).collect()
    return {(r.audio_id, r.cue_no, r.part_no): list(r.samples) for r in cut}


def test_cuts_equal_slices_of_the_whole_signal(spark):
    (one, first), (two, second) = recording(spark, 1, 1234), recording(spark, 2, 77)
    rng = random.Random(5)
    rows = [(a, i, rng.randrange(-500, 40_000), rng.randrange(-500, 40_000)) for i in range(150) for a in (1, 2)]
    rows += [(1, 900, 0, 10**14), (1, 901, 10**14, 10**15), (3, 902, 0, 1000), (2, 903, 25, 25)]
    got = clips(first.union(second), spark.createDataFrame(rows, CUES))
    signals = {1: one, 2: two, 3: []}
    assert got == {
        (a, c, 0): signals[a][max(s, 0) * RATE // 1000 : max(e, 0) * RATE // 1000] for a, c, s, e in rows
    }


def test_adjacent_cuts_give_back_the_signal(spark):
    signal, frames = recording(spark, 4, 999)
    edges = [0, 130, 999, 4000, 17_025, 25_000]
    cues = spark.createDataFrame([(4, i, s, e) for i, (s, e) in enumerate(zip(edges, edges[1:]))], CUES)
    got = clips(frames.repartition(6), cues)
    assert [x for key in sorted(got) for x in got[key]] == signal


def test_long_clips_continue_in_further_rows(spark):
    signal, frames = recording(spark, 5, 2000)
    got = clips(frames, spark.createDataFrame([(5, 1, 1250, 48_000)], CUES), part_ms=5000)
    assert len(got) == 10 and max(map(len, got.values())) <= 200
    assert [x for key in sorted(got) for x in got[key]] == signal[50:1920]


def test_missing_frames_leave_the_rest(spark):
    _, frames = recording(spark, 6, 100, skip=(1, 2))
    got = clips(frames, spark.createDataFrame([(6, 1, 250, 2500), (6, 2, 500, 1500)], CUES))
    assert got[6, 1, 0] == [6010.0 + i for i in range(10)] + [6060.0 + i for i in range(40)]
    assert got[6, 2, 0] == []


def test_cutting_is_an_equi_join(spark):
    _, frames = recording(spark, 7, 100)
    plan = audio.cut_frames(frames, spark.createDataFrame([(7, 1, 0, 100)], CUES))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_duration_rate_and_mixdown(spark):
    _, frames = recording(spark, 8, 90)
    stereo = frames.withColumn("channels", F.lit(2))
    assert audio.clip_duration(frames).first().input_length == 90 / RATE
    assert audio.clip_duration(stereo).first().input_length == 45 / RATE
    mono = audio.mixdown_mono(stereo)
    assert mono.agg(F.sum(F.size("samples"))).first()[0] == 45
    assert {r.channels for r in mono.collect()} == {1}
    assert audio.rate_check(frames).first().rate_status == "needs_resample"
    assert audio.rate_check(frames, RATE).first().rate_status == "ok"


def placed_frames(spark, audio_id, sizes, frame_ms=25, rate=8820, skip=()):
    """Frames of the given sizes, cut one after the other from one signal."""
    signal, rows = [], []
    for k, size in enumerate(sizes):
        samples = [float(len(signal) + i) for i in range(size)]
        signal += samples
        if k not in skip:
            rows.append((audio_id, k, frame_ms, rate, 1, samples))
    return signal, spark.createDataFrame(rows, FRAMES)


def rows_of(frames, cues, **options):
    cut = audio.cut_frames(frames, cues, **options).collect()
    return {(r.audio_id, r.cue_no, r.part_no): (r.status, r.missing, list(r.samples)) for r in cut}


def test_uneven_frames_add_up_to_the_signal(spark):
    for sizes in ([220, 221] * 20, [221, 220] * 20, [220] * 3 + [221] * 5 + [100]):
        signal, frames = placed_frames(spark, 1, sizes)
        cues = [(1, i, s, e) for i, (s, e) in enumerate([(0, 10**9), (50, 100), (24, 26), (25, 50), (0, 500), (333, 777)])]
        got = rows_of(frames.repartition(5), spark.createDataFrame(cues, CUES))
        for a, c, s, e in cues:
            want = signal[s * 8820 // 1000 : e * 8820 // 1000]
            assert got[a, c, 0] == (("ok" if want else "empty"), 0, want)


def test_a_gap_is_told_and_what_follows_keeps_its_place(spark):
    sizes = [220, 221] * 5
    signal, frames = placed_frames(spark, 1, sizes, skip=(4,))
    got = rows_of(frames, spark.createDataFrame([(1, 1, 0, 100), (1, 2, 0, 200), (1, 3, 125, 200)], CUES))
    assert got[1, 1, 0] == ("ok", 0, signal[:882])
    assert got[1, 2, 0] == ("gap", 220, signal[:882] + signal[1102:1764])
    assert got[1, 3, 0] == ("ok", 0, signal[1102:1764])
    # A frame cut short in the middle is a gap as well; the last one may be short.
    short = [220, 221, 100, 221, 100]
    _, frames = placed_frames(spark, 2, short)
    got = rows_of(frames, spark.createDataFrame([(2, 1, 0, 10_000), (2, 2, 75, 100)], CUES))
    assert got[2, 1, 0][:2] == ("gap", 120) and len(got[2, 1, 0][2]) == sum(short)
    assert got[2, 2, 0][2] == [541.0 + i for i in range(221)]


def test_a_whole_part_may_be_missing(spark):
    signal, frames = placed_frames(spark, 1, [100] * 10, frame_ms=100, rate=1000, skip=(2, 3, 4))
    got = rows_of(frames, spark.createDataFrame([(1, 1, 50, 900)], CUES), part_ms=200)
    assert [(p, *got[1, 1, p][:2], len(got[1, 1, p][2])) for p in range(5)] == [
        (0, "gap", 50, 150), (1, "gap", 200, 0), (2, "gap", 50, 150), (3, "ok", 0, 200), (4, "ok", 0, 50)
    ]
    assert [x for p in range(5) for x in got[1, 1, p][2]] == signal[50:200] + signal[500:900]


def test_rates_audio_and_cues_that_cannot_be_cut(spark):
    _, one = placed_frames(spark, 1, [220, 221])
    _, other = placed_frames(spark, 1, [220, 221, 200, 200], rate=8000, skip=(0, 1))
    _, two = placed_frames(spark, 2, [220, 221])
    cues = [(1, 1, 0, 50), (2, 1, 10, 10), (2, 2, 30, 5), (2, 3, None, 5), (2, 4, 10**17, 10**18), (9, 1, 0, 50), (None, 1, 0, 50)]
    got = rows_of(one.union(other).union(two), spark.createDataFrame(cues, CUES))
    assert {k: v[0] for k, v in got.items()} == {
        (1, 1, 0): "mixed_rate", (2, 1, 0): "empty", (2, 2, 0): "empty", (2, 3, 0): "empty", (2, 4, 0): "empty",
        (9, 1, 0): "no_audio", (None, 1, 0): "no_audio",
    }
    assert all(v[1:] == (0, []) for v in got.values())


def test_equal_cues_give_a_clip_each(spark):
    signal, frames = recording(spark, 1, 400)
    cut = audio.cut_frames(frames, spark.createDataFrame([(1, 1, 0, 4000)] * 2, CUES)).collect()
    assert [list(r.samples) for r in cut] == [signal[:160]] * 2


def test_blocks_of_frames_carry_on(spark, monkeypatch):
    monkeypatch.setattr(audio, "FRAMES_IN_BLOCK", 4)
    sizes = [220, 221] * 12
    _, frames = placed_frames(spark, 1, sizes, skip=(5, 13, 14))
    placed = {r.frame_no: r.first_sample for r in audio.place_frames(frames.repartition(3)).collect()}
    assert placed == {k: sum(sizes[:k]) for k in range(24) if k not in (5, 13, 14)}


def test_mixdown_of_many_channels_nulls_and_odd_sizes(spark):
    rows = [(i, c, x) for i, (c, x) in enumerate([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0, 6.0, 9.0]), (3, [1.0, 2.0, 6.0]), (2, [7.0]), (2, []), (2, None), (1, None), (6, [float(k) for k in range(12)])])]
    frames = spark.createDataFrame(rows, "i int, channels int, samples array<float>")
    found = {r.i: r.samples for r in audio.mixdown_mono(frames).collect()}
    assert found == {0: [1.0, 2.0], 1: [1.5, 4.5], 2: [3.0], 3: [], 4: [], 5: None, 6: None, 7: [2.5, 8.5]}
