"""From a manifest to clips with their texts, and from clips to a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueloom.functions.paths import manifest_audio_name, path_basename
from cueloom.functions.text import fold_newlines
from cueloom.operators.audio import cut_frames, mixdown_mono
from cueloom.operators.cues import all_cues, clip_ids, skip_done_clips
from cueloom.operators.dataset import build_dataset
from cueloom.operators.manifest import both_files_exist, manifest_complete
from cueloom.operators.pairs import pair_clips

# What tells one clip from all others; the clip name alone does not.
CLIP_KEY = ["language", "audio_id", "transcript_file", "cue_no"]


def manifest_cues(
    manifest: DataFrame, audio: DataFrame, transcripts: DataFrame, done: DataFrame | None = None
) -> DataFrame:
    """Named cues of every manifest row whose files exist, less the clips in ``done``.

    ``audio`` is a listing, ``transcripts`` has ``(path, body)``. A cue's
    ``audio_id`` is the audio file's name. Repeated manifest rows count once. Of
    several transcripts of one name in different folders the one of the smallest
    path is meant, as everywhere that a manifest names a file.
    """
    ready = both_files_exist(manifest_complete(manifest), audio, transcripts).select(
        "language",
        manifest_audio_name(F.col("media_file")).alias("audio_id"),
        "transcript_file",
    ).distinct()
    named = transcripts.select(path_basename(F.col("path")).alias("transcript_file"), "path")
    first = named.groupBy("transcript_file").agg(F.min("path").alias("path"))
    bodies = transcripts.select("path", "body").join(first, "path")
    cues = all_cues(ready.join(bodies, "transcript_file").drop("path"), path="transcript_file")
    named = clip_ids(cues, path="audio_id")
    return named if done is None else skip_done_clips(named, done, CLIP_KEY)


def cut_clips(frames: DataFrame, cues: DataFrame) -> DataFrame:
    """Cue columns, ``part_no`` and mono ``samples`` of every cue."""
    return cut_frames(mixdown_mono(frames), cues)


def paired_dataset(media: DataFrame, transcripts: DataFrame) -> DataFrame:
    """``(audio, sentence, language)`` of media that have a transcript.

    ``media`` has ``(language, path)``, ``transcripts`` also ``body``. Only the
    matched texts are carried through the pairing.
    """
    pairs = pair_clips(media, transcripts, ["language"])
    bodies = transcripts.select(
        "language", F.col("path").alias("transcript_path"), fold_newlines(F.col("body")).alias("sentence")
    )
    return build_dataset(pairs.join(bodies, ["language", "transcript_path"]), "media_path", "sentence")
