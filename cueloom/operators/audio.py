"""Framed audio: mixdown, duration, rate, and cutting by cue.

A recording is many rows ``(audio_id, frame_no, frame_ms, sample_rate,
channels, samples)``; a whole recording is never one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cueloom.constants import SAMPLE_RATE
from cueloom.functions.signal import mixdown
from cueloom.runtime import checkpointed

# A clip up to this long is one row; a longer one continues in further rows.
PART_MS = 300_000

# Frames whose sizes are summed up in one group.
FRAMES_IN_BLOCK = 4096


def mixdown_mono(frames: DataFrame) -> DataFrame:
    """Frames with their channels averaged to one."""
    return frames.withColumn("samples", mixdown(F.col("samples"), F.col("channels"))).withColumn(
        "channels", F.lit(1)
    )


def clip_duration(frames: DataFrame, key: str = "audio_id") -> DataFrame:
    """``input_length`` in seconds per recording or clip. Counts are exact integers."""
    return (
        frames.groupBy(key, "sample_rate")
        .agg(F.sum(F.floor(F.size("samples") / F.col("channels"))).alias("n"))
        .select(key, "sample_rate", (F.col("n") / F.col("sample_rate")).alias("input_length"))
    )


def rate_check(frames: DataFrame, target: int = SAMPLE_RATE) -> DataFrame:
    """Add ``rate_status``: ``ok``, or ``needs_resample`` for a user's batch function."""
    return frames.withColumn(
        "rate_status", F.when(F.col("sample_rate") == target, "ok").otherwise("needs_resample")
    )


def place_frames(frames: DataFrame) -> DataFrame:
    """``(audio_id, frame_no, frame_ms, sample_rate, n, first_sample)``: where each frame lies in its recording.

    Frames that follow each other without a break continue each other, whatever
    their sizes: frames of 220 and 221 samples add up as the whole signal does. A
    break is a missing frame, one more than a sample short of its ``frame_ms``, or
    a change of rate or ``frame_ms``; the frame after it starts where its number
    puts it on the time axis. ``(audio_id, frame_no)`` must be unique. Only sizes
    are shuffled. Sums run inside blocks of frames, and then over the table of
    blocks, so that a long recording is spread over many tasks.
    """
    meta = frames.select("audio_id", "frame_no", "frame_ms", "sample_rate", F.size("samples").cast("long").alias("n"))
    whole = F.expr("frame_ms * sample_rate - n * 1000 < 1000")
    before = meta.select(
        "audio_id",
        (F.col("frame_no") + 1).alias("frame_no"),
        F.struct("frame_ms", "sample_rate").alias("_clock"),
        whole.alias("_whole"),
    )
    follows = F.col("_whole") & (F.col("_clock") == F.struct("frame_ms", "sample_rate"))
    linked = meta.join(before, ["audio_id", "frame_no"], "left")
    linked = linked.withColumn("_break", ~F.coalesce(follows, F.lit(False))).drop("_clock", "_whole")
    linked = linked.withColumn("_block", F.expr(f"frame_no div {FRAMES_IN_BLOCK}"))

    inside = Window.partitionBy("audio_id", "_block").orderBy("frame_no")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    on_axis = F.expr("cast(frame_no as bigint) * frame_ms * sample_rate div 1000")
    summed = linked.withColumn("_sum", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    summed = summed.withColumn("_offset", F.when(F.col("_break"), on_axis - F.col("_sum")))

    blocks = summed.groupBy("audio_id", "_block").agg(
        F.sum("n").alias("_n"), F.max(F.when(F.col("_break"), F.struct("frame_no", "_offset")))["_offset"].alias("_last")
    )
    so_far = Window.partitionBy("audio_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
    carried = F.last(F.col("_last") - F.col("_before"), ignorenulls=True).over(so_far)
    blocks = blocks.select("audio_id", "_block", (carried + F.col("_before")).alias("_base"))

    offset = F.last("_offset", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = summed.withColumn("_offset", offset).join(blocks, ["audio_id", "_block"])
    first = F.coalesce("_offset", "_base") + F.col("_sum")
    return placed.select("audio_id", "frame_no", "frame_ms", "sample_rate", "n", first.alias("first_sample"))


def cut_frames(frames: DataFrame, cues: DataFrame, part_ms: int = PART_MS) -> DataFrame:
    """Mono samples ``[start_ms, end_ms)`` of every cue.

    Returns the cue columns plus ``part_no``, ``samples``, ``status`` and
    ``missing``. Cues are clamped to the recording, so a wild end time costs
    nothing. Clips longer than ``part_ms`` come in rows of that length, in order
    of ``part_no``, so no row grows with the recording. Equal cue rows give a
    clip each.

    ``status`` of a row: ``ok``; ``gap`` if the recording lacks ``missing`` of its
    samples, the others being there in order; ``overlap`` if frames hold some
    samples twice (``missing`` is negative); ``mixed_rate`` without samples, if the
    recording's frames differ in rate; ``no_audio`` without any frame of the
    recording; ``empty`` for a cue that is inverted, incomplete or past the end.

    Samples are numbered along the recording (``place_frames``). Both cues and
    frames are laid on stretches of a frame's length, and meet by equality on
    ``(audio_id, stretch)``, in the first stretch that both touch. Only sizes take
    part in that; the samples are shuffled once to the slices that need them, and
    once to their clips.
    """
    placed = checkpointed(place_frames(frames))
    extent = placed.groupBy("audio_id").agg(
        F.max(F.col("first_sample") + F.col("n")).alias("_total"),
        F.min("sample_rate").alias("_rate"),
        F.max("sample_rate").alias("_other_rate"),
        F.greatest(F.max(F.expr("frame_ms * sample_rate div 1000")), F.lit(1)).alias("_width"),
    )
    cue_key = cues.columns
    # Past the end by a second is as good as any later time, and cannot overflow.
    sample = lambda ms: f"least(greatest({ms}, 0L), _total * 1000 div _rate + 1000) * _rate div 1000"
    spans = (
        cues.groupBy(*cue_key)
        .agg(F.count("*").alias("_copies"))
        .join(extent, "audio_id", "left")
        .withColumn("_status", F.expr("if(_rate is null, 'no_audio', if(_rate <> _other_rate, 'mixed_rate', 'ok'))"))
        .withColumn("_from", F.expr(sample("start_ms")))
        .withColumn("_to", F.expr(f"least({sample('end_ms')}, _total)"))
        .withColumn("_some", F.coalesce(F.expr("_status = 'ok' and _from < _to and start_ms is not null and end_ms is not null"), F.lit(False)))
        .withColumn("_status", F.expr("if(_status = 'ok' and not _some, 'empty', _status)"))
        .withColumn("_part", F.expr(f"greatest({part_ms}L * _rate div 1000, 1L)"))
    )
    parts = spans.select(
        "*", F.explode(F.expr("if(_some, sequence(0L, (_to - _from - 1) div _part), array(0L))")).alias("part_no")
    )
    parts = parts.withColumn("_lo", F.expr("if(_some, _from + part_no * _part, 0L)")).withColumn(
        "_hi", F.expr("if(_some, least(_to, _lo + _part), 0L)")
    )
    touched = parts.select(
        *cue_key, "_copies", "_status", "part_no", "_lo", "_hi", F.expr("_lo div _width").alias("_cue_stretch"),
        F.explode_outer(F.expr("if(_hi > _lo, sequence(_lo div _width, (_hi - 1) div _width), null)")).alias("_stretch"),
    )
    laid = placed.where("n > 0").join(extent.select("audio_id", "_width"), "audio_id")
    laid = laid.select(
        "audio_id", "frame_no", F.col("first_sample").alias("_first"), F.col("n").alias("_n"),
        F.expr("first_sample div _width").alias("_frame_stretch"),
        F.explode(F.expr("sequence(first_sample div _width, (first_sample + n - 1) div _width)")).alias("_stretch"),
    )
    meets = F.expr("_first < _hi and _first + _n > _lo and _stretch = greatest(_cue_stretch, _frame_stretch)")
    met = touched.join(laid, ["audio_id", "_stretch"], "left").withColumn("_meets", F.coalesce(meets, F.lit(False)))
    wanted = met.withColumn("frame_no", F.when(F.col("_meets"), F.col("frame_no"))).select(
        *cue_key, "_copies", "_status", "part_no", "_lo", "_hi", "frame_no", "_first",
        F.expr("greatest(_lo, _first) - _first").alias("_at"),
        F.expr("if(_meets, least(_hi, _first + _n) - greatest(_lo, _first), 0L)").alias("_size"),
    )
    pieces = wanted.join(frames.select("audio_id", "frame_no", "samples"), ["audio_id", "frame_no"], "left").select(
        *cue_key, "_copies", "_status", "part_no", "_lo", "_hi", "_first", "_size",
        F.expr("slice(samples, cast(_at as int) + 1, cast(_size as int))").alias("_piece"),
    )
    ordered = F.sort_array(F.collect_list(F.when(F.col("_piece").isNotNull(), F.struct("_first", "_piece"))))
    # Shuffled before grouping: collecting cannot shrink the pieces, so a
    # map-side half of it would only sort and spill the audio once more.
    keys = [*cue_key, "_copies", "_status", "part_no", "_lo", "_hi"]
    grouped = pieces.repartition(*cue_key, "part_no").groupBy(*keys)
    cut = grouped.agg(F.flatten(ordered["_piece"]).alias("samples"), F.sum("_size").alias("_got"))
    missing = F.col("_hi") - F.col("_lo") - F.col("_got")
    return cut.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(
        *cue_key,
        "part_no",
        "samples",
        F.when(missing > 0, "gap").when(missing < 0, "overlap").otherwise(F.col("_status")).alias("status"),
        missing.alias("missing"),
    )
