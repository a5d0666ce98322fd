"""Pipeline inputs derived from the given Parquet tables, row by row.

Every table is used whole and every text in full. ``oracles`` derives the same
rows in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cueloom.runtime import spread

LANGUAGE_OF_ID = "case {0} % 4 when 0 then 'en' when 1 then 'fi' when 2 then 'sv' else 'da' end"

_MEDIA_EXT = (
    "case page_id % 5 when 0 then '.mp4' when 1 then '.mov' when 2 then '.wav' when 3 then '.mp3' else '.MP4' end"
)
_TEXT_EXT = "case page_id % 3 when 0 then '.srt' when 1 then '.vtt' else '.txt' end"
_HOST = "regexp_extract(url, '//([^/]+)', 1)"


# Long texts: work per row far outweighs moving the row.
_TEXT_TABLES = ("documents", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in _TEXT_TABLES else rows


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing cells, bare-number names with an ambiguous ending, kinds in both cases."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id as manifest_id",
        f"""case when page_id % 17 = 0 then null
            else concat(case when page_id % 7 = 0 then '' else 'clip_' end, page_id, {_MEDIA_EXT}) end
            as media_file""",
        f"concat('clip_', page_id, {_TEXT_EXT}) as transcript_file",
        f"{LANGUAGE_OF_ID.format('page_id')} as language",
    )


def media_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per page; an unfinished upload ends in ``.part``."""
    return table(spark, sf_dir, "pages").selectExpr(
        f"concat({_HOST}, '/clip_', page_id, {_MEDIA_EXT}, if(page_id % 11 = 0, '.part', '')) as path",
        "cast(length(url) as long) as length",
    )


def transcript_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").selectExpr(
        f"concat({_HOST}, '/clip_', page_id, {_TEXT_EXT}) as path", "cast(length(url) as long) as length"
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_objects(spark, sf_dir).unionByName(transcript_objects(spark, sf_dir))


def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run over the English section left behind."""
    english = table(spark, sf_dir, "pages").where("url like '%/en/%'")
    return english.selectExpr(
        f"""explode(array(concat('local/clip_', page_id, '.wav'),
                          concat('local/clip_', page_id, {_TEXT_EXT}))) as path"""
    )


def encoded_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media whose names hold escapes."""
    return media_objects(spark, sf_dir).selectExpr("replace(path, '/clip_', '/clip%20+') as path")


def encoded_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts with plain or escaped names; some belong to no media."""
    return table(spark, sf_dir, "pages").selectExpr(
        f"""concat({_HOST}, case when page_id % 13 = 0 then '/draft ' when page_id % 2 = 0 then '/clip +'
                            else '/clip%20+' end, page_id, {_TEXT_EXT}) as path"""
    )


def _clock(ms: Column, mark: str, short: bool = False) -> Column:
    hours, rest = F.floor(ms / 3_600_000), ms % 3_600_000
    tail = F.format_string(
        f"%02d:%02d{mark}%03d", F.floor(rest / 60_000), F.floor(rest % 60_000 / 1000), rest % 1000
    )
    full = F.concat(F.format_string("%02d:", hours), tail)
    return F.when(hours == 0, tail).otherwise(full) if short else full


def _start(i: Column) -> Column:
    return F.col("turn") * 4000 + F.col("conv_id") * 37 + i.cast("long") * 2000


def _subtitles(spark: SparkSession, sf_dir: str, extension: Column, body: Column) -> DataFrame:
    """One subtitle file per turn, one cue per line of its text."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.concat(F.lit("subs/conv_"), "conv_id", F.lit("_"), "turn", extension).alias("path"),
        body.alias("body"),
    )


def _srt_body() -> Column:
    def block(line: Column, i: Column) -> Column:
        index = F.when(i % 5 == 4, "").otherwise(F.concat((i + 1).cast("string"), F.lit("\r\n")))
        times = F.concat(_clock(_start(i), ","), F.lit(" --> "), _clock(_start(i) + 1500, ","))
        return F.concat(index, times, F.lit("\r\n<i>"), F.col("role"), F.lit("</i>\r\n"), line)

    blocks = F.transform(F.split("text", "\n"), block)
    return F.concat(F.lit("\ufeff"), F.array_join(blocks, "\r\n\r\n"), F.lit("\r\n\r\nno timing here\r\n"))


def _vtt_body() -> Column:
    def block(line: Column, i: Column) -> Column:
        name = F.when(i % 4 == 0, "").otherwise(F.concat(F.lit("cue "), i, F.lit("\n")))
        times = F.concat(_clock(_start(i), ".", True), F.lit(" --> "), _clock(_start(i) + 1500, "."))
        return F.concat(name, times, F.lit(" align:start line:0\n<v "), F.col("role"), F.lit(">"), line, F.lit("</v>"))

    head = F.lit("WEBVTT - subtitles\n\nNOTE from a table\nof turns\n\nSTYLE\n::cue { color: red }\n\n")
    return F.concat(head, F.array_join(F.transform(F.split("text", "\n"), block), "\n\n"), F.lit("\n"))


def srt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subtitles(spark, sf_dir, F.lit(".srt"), _srt_body())


def vtt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subtitles(spark, sf_dir, F.lit(".vtt"), _vtt_body())


def subtitle_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats by speaker: users SRT, assistants WebVTT, system text unsupported."""
    role = F.col("role")
    extension = F.when(role == "user", ".srt").when(role == "assistant", ".vtt").otherwise(".txt")
    body = F.when(role == "user", _srt_body()).when(role == "assistant", _vtt_body()).otherwise(F.col("text"))
    return _subtitles(spark, sf_dir, extension, body)


def write_files(files: DataFrame, root: str) -> None:
    """Write each ``(path, body)`` as a file of that name below ``root``; every task writes its own rows."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.fs as fs

        store, base = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        made = set()
        for batch in batches:
            for path, body in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                target = f"{base}/{path}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(target) as out:
                    out.write(body.encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    files.select("path", "body").mapInArrow(run, "n long").agg(F.sum("n")).collect()


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 one-second frames at 64 Hz per recording; even rows are mono, odd ones stereo."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id div 50 as audio_id",
        "vec_id % 50 as frame_no",
        "1000 as frame_ms",
        "64 as sample_rate",
        "cast(1 + vec_id % 2 as int) as channels",
        "label",
        "embedding as samples",
    )


def mono_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).withColumn("channels", F.lit(1))


def frame_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cue per frame row; the last ones pass the end, every 16th is inverted."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id div 50 as audio_id",
        "vec_id % 50 as cue_no",
        "vec_id % 50 * 1100 + 125 as start_ms",
        "vec_id % 50 * 1100 + if(vec_id % 16 = 15, 25, 2425) as end_ms",
    )


def uneven_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of 25 ms at 2,540 Hz, 63 and 64 samples in turn; frames 17, 18 and 40 of each recording are missing."""
    there = frames(spark, sf_dir).where("frame_no not in (17, 18, 40)")
    return there.selectExpr(
        "audio_id",
        "frame_no",
        "25 as frame_ms",
        "2540 as sample_rate",
        "1 as channels",
        "slice(samples, 1, 63 + cast(frame_no % 2 as int)) as samples",
    )


def uneven_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues of up to 500 ms; some meet missing frames, pass the end, are inverted, or name no recording."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "if(vec_id % 29 = 0, -1L, vec_id div 50) as audio_id",
        "vec_id % 50 as cue_no",
        "vec_id % 50 * 26 + 7 as start_ms",
        "vec_id % 50 * 26 + 7 + (vec_id * 37) % 520 - 20 as end_ms",
    )


def named_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stereo recordings under file names: 64 values are half a second of two channels."""
    return frames(spark, sf_dir).selectExpr(
        "concat('rec_', audio_id, '.wav') as audio_id",
        "frame_no",
        "500 as frame_ms",
        "sample_rate",
        "2 as channels",
        "samples",
    )


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of the recordings there are frames of."""
    names = frames(spark, sf_dir).select("audio_id").distinct()
    return names.selectExpr("concat('audio/rec_', audio_id, '.wav') as path")


def turn_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per turn: its conversation's recording and its own subtitle file."""
    files = subtitle_files(spark, sf_dir)
    return files.selectExpr(
        "conv_id * 100 + turn as manifest_id",
        "concat('rec_', conv_id, '.mp4') as media_file",
        "substring_index(path, '/', -1) as transcript_file",
        f"{LANGUAGE_OF_ID.format('conv_id')} as language",
    )


def turn_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text file per turn, named with escapes."""
    return table(spark, sf_dir, "conversations").selectExpr(
        f"{LANGUAGE_OF_ID.format('conv_id')} as language",
        "concat('text/conv%20', conv_id, '+', turn, '.txt') as path",
        "text as body",
    )


def turn_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips of all turns but the system's."""
    spoken = table(spark, sf_dir, "conversations").where("role <> 'system'")
    return spoken.selectExpr(
        f"{LANGUAGE_OF_ID.format('conv_id')} as language",
        "concat('media/conv ', conv_id, '+', turn, '.wav') as path",
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole turns as references; a fixed edit pattern makes the hypotheses."""
    words = table(spark, sf_dir, "conversations").withColumn("w", F.split("text", "[ \n]"))
    return words.selectExpr(
        "conv_id",
        "turn",
        f"{LANGUAGE_OF_ID.format('conv_id')} as language",
        "concat('audio/conv_', conv_id, '_', turn, '.wav') as audio_path",
        "array_join(w, ' ') as reference",
        """case when (conv_id + turn) % 13 = 0 then '' else array_join(flatten(transform(w, (x, i) ->
             case when i % 7 = 3 then array() when i % 11 = 5 then array('xx')
                  when i % 13 = 8 then array(x, x) else array(x) end)), ' ') end as hypothesis""",
    )


def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio on disk: system turns were never recorded."""
    spoken = table(spark, sf_dir, "conversations").where("role <> 'system'")
    return spoken.selectExpr("concat('audio/conv_', conv_id, '_', turn, '.wav') as path")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_type as run", "event_id as step", "value as wer")


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id as row_id", "lang as language", "text as sentence", "n_chars / 15D as input_length"
    )
