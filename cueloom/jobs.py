"""One command per stage: ``spark-submit cueloom/jobs.py STAGE …`` or ``cueloom STAGE …``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from cueloom.operators.scoring import score, wer_by_language
from cueloom.plans.acquisition import acquisition_plan, run_summary
from cueloom.plans.clips import cut_clips, manifest_cues, paired_dataset
from cueloom.runtime import clear_scratch, session
from cueloom.sources.datasets import other_clips, write_clips, write_dataset, write_results
from cueloom.sources.listing import list_objects, read_transcripts, write_listing
from cueloom.sources.manifest import read_manifest
from cueloom.streaming.incremental import append_new_cues


def _found(spark: SparkSession, path: str) -> DataFrame:
    """A saved listing table, or the listing of a folder if there is none."""
    return spark.read.parquet(path) if path.endswith(".parquet") else list_objects(spark, path)


def listing(spark: SparkSession, args: argparse.Namespace) -> None:
    """List a store once into a table."""
    write_listing(spark, args.root, args.out)


def plan(spark: SparkSession, args: argparse.Namespace) -> None:
    """What to fetch: a status for each manifest row, and the number of each status below it."""
    rows = acquisition_plan(
        read_manifest(spark, args.manifest),
        _found(spark, args.objects),
        _found(spark, args.present),
        args.exclude_email,
        args.exclude_domain,
        spark.read.text(args.exclude_list) if args.exclude_list else None,
    )
    rows.write.mode("overwrite").parquet(f"{args.out}/plan")
    run_summary({"acquire": spark.read.parquet(f"{args.out}/plan")}).write.mode("overwrite").parquet(f"{args.out}/summary")


def cues(spark: SparkSession, args: argparse.Namespace) -> None:
    """Cues of the subtitle files that are new since the last run, with a status for each file."""
    append_new_cues(spark, args.subtitles, args.out, args.state).awaitTermination()


def clips(spark: SparkSession, args: argparse.Namespace) -> None:
    """Cut audio of all cues of a manifest, as one batch."""
    frames, subtitles = spark.read.parquet(args.frames), read_transcripts(spark, args.subtitles)
    done = other_clips(spark, args.out, args.batch) if args.resume else None
    found = manifest_cues(read_manifest(spark, args.manifest), _found(spark, args.audio), subtitles, done)
    write_clips(cut_clips(frames, found), args.out, args.batch)


def dataset(spark: SparkSession, args: argparse.Namespace) -> None:
    """Dataset of media that have a transcript: ``(language, path)`` and ``(language, path, body)`` tables."""
    write_dataset(paired_dataset(spark.read.parquet(args.media), spark.read.parquet(args.transcripts)), args.out)


def evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Score pairs: the result sheet, and the word error rate by language."""
    pairs = spark.read.parquet(args.pairs)
    scored = score(pairs)
    wer_by_language(scored).write.mode("overwrite").parquet(f"{args.out}/wer")
    sheet = pairs.selectExpr("reference as Reference", "hypothesis as Result", "audio_path as Audio_File", "language")
    write_results(sheet, args.out)


_STAGES = {
    listing: ["root", "out"],
    plan: ["manifest", "objects", "present", "out"],
    cues: ["subtitles", "out", "state"],
    clips: ["manifest", "audio", "frames", "subtitles", "out", "batch"],
    dataset: ["media", "transcripts", "out"],
    evaluate: ["pairs", "out"],
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cueloom", description=__doc__)
    stages = top.add_subparsers(required=True)
    for stage, names in _STAGES.items():
        one = stages.add_parser(stage.__name__, help=stage.__doc__)
        one.set_defaults(stage=stage)
        for name in names:
            one.add_argument(f"--{name}", required=True)
        if stage is plan:
            one.add_argument("--exclude-email", action="append", default=[])
            one.add_argument("--exclude-domain", action="append", default=[])
            one.add_argument("--exclude-list", help="text files with an excluded text on each line, of any number")
        if stage is clips:
            one.add_argument("--resume", action="store_true", help="skip what other batches have cut")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session(f"cueloom-{args.stage.__name__}")
    args.stage(spark, args)
    clear_scratch(spark)


if __name__ == "__main__":
    main()
