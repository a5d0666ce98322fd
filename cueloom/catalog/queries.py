"""One query per operator, over the inputs of ``tables``.

Arrays are rendered as text and integers widened, so that results compare as
plain values.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cueloom.catalog import tables as t
from cueloom.catalog.oracles import LABEL_LANGUAGES, MAX_LABELS, PAIR_VOCAB_SIZE, VOCAB_SIZE
from cueloom.constants import SHUFFLE_SEED
from cueloom.functions import paths, text
from cueloom.operators import audio, batchmap, checkpoints, cues, dataset, labels, manifest, ordering, pairs, scoring
from cueloom.plans import acquisition, clips, evaluation, training
from cueloom.runtime import checkpointed, scratch_path
from cueloom.sources import datasets, lines, listing
from cueloom.sources import manifest as manifest_source
from cueloom.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

_NAMES = {"media_file": "media_path", "transcript_file": "transcript_path"}
_EXCLUDED_DOMAINS = ["example.net"]
_PAIR_KEY = ["conv_id", "turn"]


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def _scalar(name: str, source: Callable, key: str, value: Callable[[], Column], into: str = "value") -> None:
    """Register a column function applied to a whole input."""
    _QUERIES[name] = lambda spark, sf: source(spark, sf).select(key, value().alias(into))


def _table(name: str) -> Callable:
    return lambda spark, sf: t.table(spark, sf, name)


def _joined(name: str) -> Column:
    return F.array_join(F.col(name).cast("array<string>"), ",").alias(name)


def _fixed(name: str = "samples") -> Column:
    millionths = F.transform(name, lambda x: F.round(x.cast("double") * 1_000_000).cast("long").cast("string"))
    return F.array_join(millionths, ",").alias(name)


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# Sources and sinks: written to scratch, then read back.


@_query
def read_manifest(spark, sf):
    path = scratch_path(spark, "manifest")
    t.manifest(spark, sf).write.option("header", True).csv(path)
    return manifest_source.read_manifest(spark, path)


@_query
def list_objects(spark, sf):
    """Files written in folders of two levels, listed into a table; each path is found by the row it was written for."""
    root = scratch_path(spark, "objects")
    files = t.table(spark, sf, "documents").selectExpr("lang", "concat(source, '%20 a') as source", "text")
    files.repartition("lang", "source").write.partitionBy("lang", "source").text(f"{root}/in")
    found = listing.write_listing(spark, f"{root}/in", f"{root}/listed", prefixes=16)
    parts = F.regexp_extract("path", "/in/lang=([^/]+)/source=([^/]+)/part-[^/]+$", 1)
    source = F.regexp_extract("path", "/in/lang=([^/]+)/source=([^/]+)/part-[^/]+$", 2)
    named = found.select(parts.alias("language"), F.regexp_replace(source, "%2520", "%20").alias("source"), "length")
    return named.groupBy("language", "source").agg(F.sum("length").alias("bytes")).where("language <> ''")


@_query
def read_lines(spark, sf):
    path = scratch_path(spark, "lines")
    texts = t.table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "value"))
    texts.orderBy("doc_id", "at").select("value").write.text(path)
    return lines.read_lines(spark, path)


@_query
def read_transcripts(spark, sf):
    root = scratch_path(spark, "transcripts")
    turns = t.table(spark, sf, "conversations").select("role", "text")
    turns.write.partitionBy("role").option("maxRecordsPerFile", 1000).text(root)
    files = listing.read_transcripts(spark, root)
    body_lines = F.explode(F.split(F.regexp_replace("body", r"\n\z", ""), "\n")).alias("line")
    by_role = files.select(F.regexp_extract("path", "/role=([^/]+)/", 1).alias("role"), body_lines)
    return by_role.groupBy("role", "line").agg(F.count("*").alias("n"))


def _dataset(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.build_dataset(t.pairs(spark, sf), "audio_path", "reference")


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(
        *[c for c in rows.columns if c not in ("audio", "sentence", "language")],
        F.col("audio.path").alias("audio_path"),
        F.col("audio.sample_rate").cast("long").alias("sample_rate"),
        "sentence",
        "language",
    )


@_query
def build_dataset(spark, sf):
    return _flat(_dataset(spark, sf))


@_query
def concat_datasets(spark, sf):
    return _flat(datasets.concat_datasets(_dataset(spark, sf), _dataset(spark, sf)))


@_query
def write_dataset(spark, sf):
    out = scratch_path(spark, "dataset")
    datasets.write_dataset(_dataset(spark, sf), out)
    return _flat(spark.read.parquet(out))


@_query
def load_datasets(spark, sf):
    out = scratch_path(spark, "datasets")
    datasets.write_dataset(_dataset(spark, sf), out)
    return _flat(datasets.load_datasets(spark, [out, f"{out}/language=fi"]))


def _cut(spark: SparkSession, sf: str) -> DataFrame:
    return audio.cut_frames(t.mono_frames(spark, sf), t.frame_cues(spark, sf))


@_query
def cut_frames(spark, sf):
    return _cut(spark, sf).select("audio_id", "cue_no", F.col("part_no").cast("long"), _fixed())


@_query
def cut_uneven_frames(spark, sf):
    """Uneven frames with gaps, cut into parts of 100 ms."""
    cut = audio.cut_frames(t.uneven_frames(spark, sf), t.uneven_cues(spark, sf), part_ms=100)
    return cut.select("audio_id", "cue_no", "part_no", "status", "missing", _fixed())


@_query
def write_clips(spark, sf):
    out = scratch_path(spark, "clips")
    language = F.expr(t.LANGUAGE_OF_ID.format("audio_id"))
    cut = _cut(spark, sf).withColumn("language", language)
    # Two batches, and the first one once more.
    for batch, rest in (("even", 0), ("odd", 1), ("even", 0)):
        datasets.write_clips(cut.where(F.col("cue_no") % 2 == rest), out, batch)
    return spark.read.parquet(out).select("audio_id", "cue_no", "language", _fixed())


@_query
def cut_clips(spark, sf):
    cues_to_cut = clips.manifest_cues(
        t.turn_manifest(spark, sf), t.recordings(spark, sf), t.subtitle_files(spark, sf).select("path", "body")
    )
    cut = clips.cut_clips(t.named_frames(spark, sf), cues_to_cut)
    return cut.select("clip_id", "language", "transcript_file", "text", F.col("part_no").cast("long"), _fixed())


@_query
def paired_dataset(spark, sf):
    return _flat(clips.paired_dataset(t.turn_media(spark, sf), t.turn_texts(spark, sf)))


@_query
def write_pair_lists(spark, sf):
    out = scratch_path(spark, "lists")
    languages = ["da", "en", "fi", "sv"]
    lines.write_pair_lists(t.pairs(spark, sf), out, languages, _PAIR_KEY, "audio_path", "reference")
    back = []
    for language in languages:
        zipped = pairs.zip_lines(
            *(lines.read_lines(spark, lines.list_path(out, name, language)) for name in ("media", "transcription"))
        )
        back.append(zipped.withColumn("language", F.lit(language)))
    return datasets.concat_datasets(*back)


@_query
def zip_lines(spark, sf):
    out = scratch_path(spark, "zip")
    docs = t.table(spark, sf, "documents").orderBy("doc_id")
    docs.select("source").write.text(f"{out}/media")
    docs.select(text.fold_newlines(F.col("text"))).write.text(f"{out}/sentence")
    return pairs.zip_lines(lines.read_lines(spark, f"{out}/media"), lines.read_lines(spark, f"{out}/sentence"))


def _strict_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.normalised(t.pairs(spark, sf))


@_query
def result_rows(spark, sf):
    return scoring.result_rows(_strict_pairs(spark, sf))


@_query
def write_results(spark, sf):
    out = scratch_path(spark, "results")
    rows = scoring.result_rows(_strict_pairs(spark, sf))
    datasets.write_results(rows, out)
    return datasets.read_results(spark, out, rows.schema.simpleString()[len("struct<") : -1].replace(":", " "))


# Path and text functions

_pages, _documents = _table("pages"), _table("documents")
_scalar("path_basename", _pages, "page_id", lambda: paths.path_basename(F.col("url")))
_scalar("path_stem", _pages, "page_id", lambda: paths.path_stem(F.col("url")))
_scalar("path_rstem", _pages, "page_id", lambda: paths.path_rstem(F.col("url")))
_scalar("audio_target", t.listing, "path", lambda: paths.audio_target(F.col("path")), "audio_name")
_scalar("transcript_kind", t.manifest, "manifest_id", lambda: paths.transcript_kind(F.col("transcript_file")), "kind")
_scalar(
    "url_unquote",
    _pages,
    "page_id",
    lambda: paths.url_unquote(F.expr("concat(url, '+', replace(replace(html, ' ', '%20'), 'e', '%65'))")),
)
_scalar(
    "fold_newlines",
    _documents,
    "doc_id",
    lambda: text.fold_newlines(F.concat(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("\r\n\n"))),
)
_scalar(
    "strip_ws",
    _documents,
    "doc_id",
    lambda: text.strip_ws(F.concat(F.lit("\t \u00a0\n"), "text", F.lit("\r\n\u3000\x1c"))),
)
_scalar("norm_strict", _documents, "doc_id", lambda: text.norm_strict(F.col("text")))
_scalar("norm_basic", _documents, "doc_id", lambda: text.norm_basic(F.col("text")))


@_query
def media_kind(spark, sf):
    named = t.manifest(spark, sf).where("media_file is not null")
    return named.select("manifest_id", paths.media_kind(F.col("media_file")).alias("kind"))


@_query
def word_tokens(spark, sf):
    words = t.table(spark, sf, "documents").select("doc_id", text.word_tokens(F.col("text")).alias("words"))
    return words.select("doc_id", F.size("words").cast("long").alias("n"), F.array_join("words", "|").alias("words"))


# Manifest


@_query
def manifest_complete(spark, sf):
    return manifest.manifest_complete(t.manifest(spark, sf))


@_query
def supported_only(spark, sf):
    return manifest.supported_only(t.manifest(spark, sf))


@_query
def exclude_names(spark, sf):
    return manifest.exclude_names(t.listing(spark, sf), ["path"], ["m.th"], _EXCLUDED_DOMAINS)


def _listed(spark: SparkSession, sf: str) -> DataFrame:
    """A long list: parts of paths, most of which occur in none of the listed ones."""
    texts = t.table(spark, sf, "documents").selectExpr(
        "concat('clip_', doc_id, if(doc_id % 3 = 0, '.', '/'))  as text"
    )
    more = t.table(spark, sf, "supplier").selectExpr("concat('_', s_suppkey, 'x', '.mp3') as text")
    return texts.union(more)


@_query
def exclude_listed(spark, sf):
    """Paths against a long list."""
    return manifest.exclude_listed(t.listing(spark, sf), ["path"], _listed(spark, sf))


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.resolve_names(t.manifest(spark, sf), t.listing(spark, sf), _NAMES)


@_query
def resolve_names(spark, sf):
    return _resolved(spark, sf)


@_query
def resolve_exact(spark, sf):
    return manifest.resolve_exact(t.manifest(spark, sf), t.listing(spark, sf), _NAMES)


@_query
def skip_present(spark, sf):
    return manifest.skip_present(_resolved(spark, sf), t.fetched(spark, sf))


@_query
def both_files_exist(spark, sf):
    return manifest.both_files_exist(t.manifest(spark, sf), t.fetched(spark, sf), t.listing(spark, sf))


def _acquisition(spark: SparkSession, sf: str) -> DataFrame:
    return acquisition.acquisition_plan(
        t.manifest(spark, sf), t.listing(spark, sf), t.fetched(spark, sf), domains=_EXCLUDED_DOMAINS
    )


@_query
def acquisition_plan(spark, sf):
    return _acquisition(spark, sf)


@_query
def plan_with_list(spark, sf):
    """The plan where a long list excludes, beside the short ones."""
    rows, listing, present = t.manifest(spark, sf), t.listing(spark, sf), t.fetched(spark, sf)
    return acquisition.acquisition_plan(rows, listing, present, domains=_EXCLUDED_DOMAINS, excluded_texts=_listed(spark, sf))


@_query
def run_summary(spark, sf):
    cut = acquisition.cutting_plan(t.manifest(spark, sf), t.fetched(spark, sf), t.listing(spark, sf))
    return acquisition.run_summary({"acquire": _acquisition(spark, sf), "cut": cut})


# Cues


@_query
def srt_cues(spark, sf):
    return cues.srt_cues(t.srt_files(spark, sf)).drop("path")


@_query
def vtt_cues(spark, sf):
    return cues.vtt_cues(t.vtt_files(spark, sf)).drop("path")


@_query
def all_cues(spark, sf):
    return cues.all_cues(t.subtitle_files(spark, sf)).drop("path")


@_query
def clip_ids(spark, sf):
    found = cues.all_cues(t.subtitle_files(spark, sf))
    return cues.clip_ids(found).select("clip_id", "conv_id", "turn", "cue_no")


@_query
def rejected_blocks(spark, sf):
    return cues.rejected_blocks(t.subtitle_files(spark, sf)).drop("path")


@_query
def skip_done_clips(spark, sf):
    """An earlier run has cut everything but the system turns."""
    spoken = t.table(spark, sf, "conversations").where("role <> 'system'").select(*_PAIR_KEY)
    found = cues.srt_cues(t.srt_files(spark, sf))
    done = found.join(spoken, _PAIR_KEY, "left_semi")
    return cues.skip_done_clips(found, done, [*_PAIR_KEY, "cue_no"]).drop("path")


def _streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Subtitle files on disk, in two parts; the second run reads only the new files, a third finds none."""
    root = scratch_path(spark, "stream")
    files = t.subtitle_files(spark, sf)
    for part in (0, 1, None):
        if part is not None:
            t.write_files(files.where(F.col("turn") % 2 == part), f"{root}/in")
        incremental.append_new_cues(spark, f"{root}/in", f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@_query
def stream_new_cues(spark, sf):
    return _streamed(spark, sf).where("cue_no is not null").select("clip_id", "start_ms", "text")


@_query
def stream_file_status(spark, sf):
    status = incremental.file_status(_streamed(spark, sf))
    return status.select(paths.path_basename(F.col("path")).alias("file"), "status", "blocks", "cues")


# Signals


@_query
def mixdown_mono(spark, sf):
    return audio.mixdown_mono(t.frames(spark, sf)).select("audio_id", "frame_no", _fixed())


@_query
def clip_duration(spark, sf):
    return audio.clip_duration(t.frames(spark, sf)).withColumn("sample_rate", F.col("sample_rate").cast("long"))


@_query
def rate_check(spark, sf):
    rates = t.frames(spark, sf).withColumn("sample_rate", F.expr("if(label % 2 = 0, 16000, 8000)"))
    return audio.rate_check(rates).groupBy("rate_status").agg(F.count("*").alias("n"))


# Pairs


@_query
def pair_clips(spark, sf):
    return pairs.pair_clips(t.encoded_media(spark, sf), t.encoded_transcripts(spark, sf))


@_query
def unpaired_media(spark, sf):
    return pairs.unpaired_media(t.encoded_media(spark, sf), t.encoded_transcripts(spark, sf))


@_query
def audio_exists(spark, sf):
    return pairs.audio_exists(t.pairs(spark, sf), t.recorded(spark, sf)).select(*_PAIR_KEY, "audio_path")


@_query
def nonempty_pairs(spark, sf):
    return _strict_pairs(spark, sf).select(*_PAIR_KEY, "reference", "hypothesis")


@_query
def progress_sample(spark, sf):
    sample = pairs.progress_sample(_strict_pairs(spark, sf), _PAIR_KEY)
    return sample.select(*_PAIR_KEY, "language", "position", "reference")


# Dataset


@_query
def seeded_shuffle(spark, sf):
    return ordering.seeded_shuffle(t.pairs(spark, sf).select(*_PAIR_KEY), _PAIR_KEY, SHUFFLE_SEED)


@_query
def train_eval_split(spark, sf):
    split = dataset.train_eval_split(t.pairs(spark, sf), _PAIR_KEY, 80)
    return split.select(*_PAIR_KEY, "language", "split")


@_query
def exact_split(spark, sf):
    """Exact shares of documents whose languages differ much in size."""
    rows = t.sentences(spark, sf).select("row_id", "language")
    return dataset.exact_split(rows, ["row_id"], 73, seed=SHUFFLE_SEED)


@_query
def language_summary(spark, sf):
    rows = t.sentences(spark, sf)
    return _rounded(dataset.language_summary(rows, "sentence", F.col("input_length")), "seconds", digits=4)


# Labels and batches


def _label_words() -> Column:
    return text.word_tokens(text.norm_basic(F.col("sentence")))


def _vocab(spark: SparkSession, sf: str) -> DataFrame:
    return labels.build_vocab(t.sentences(spark, sf), _label_words(), VOCAB_SIZE)


def _kept_vocab(spark: SparkSession, sf: str) -> DataFrame:
    """The vocabulary, counted once however often it is used."""
    return checkpointed(_vocab(spark, sf))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    rows, vocab = t.sentences(spark, sf), _kept_vocab(spark, sf)
    return training.labelled(rows, vocab, VOCAB_SIZE, LABEL_LANGUAGES).drop("sentence")


def _in_range(spark: SparkSession, sf: str) -> DataFrame:
    rows, vocab = t.sentences(spark, sf), _kept_vocab(spark, sf)
    return training.labels_in_range(rows, vocab, VOCAB_SIZE, LABEL_LANGUAGES, MAX_LABELS).drop("sentence")


def _batches(spark: SparkSession, sf: str) -> DataFrame:
    return labels.assign_batches(_in_range(spark, sf).select("row_id", "labels"), ["row_id"])


@_query
def build_vocab(spark, sf):
    return _vocab(spark, sf)


@_query
def encode_labels(spark, sf):
    return _labelled(spark, sf).select("row_id", _joined("labels"))


@_query
def decode_labels(spark, sf):
    rows, vocab = t.sentences(spark, sf), _kept_vocab(spark, sf)
    encoded = labels.encode_labels(rows, _label_words(), vocab)
    return labels.decode_labels(encoded, vocab).select("row_id", "text")


@_query
def length_range(spark, sf):
    return _in_range(spark, sf).select("row_id", "language", "input_length", _joined("labels"))


@_query
def assign_batches(spark, sf):
    return _batches(spark, sf).select("row_id", "batch_id", "row_in_batch")


@_query
def batches_by_split(spark, sf):
    """Train and eval rows shuffled and batched apart."""
    split = dataset.train_eval_split(t.pairs(spark, sf), _PAIR_KEY, 80).select(*_PAIR_KEY, "split")
    return labels.assign_batches(split, _PAIR_KEY, by=["split"])


@_query
def pad_batches(spark, sf):
    padded = labels.pad_batches(_batches(spark, sf))
    return padded.select("row_id", "batch_id", "row_in_batch", _joined("labels"))


@_query
def strip_bos(spark, sf):
    stripped = training.training_batches(_in_range(spark, sf).select("row_id", "labels"), ["row_id"])
    return stripped.select("row_id", "batch_id", "row_in_batch", _joined("labels"))


@_query
def unmask_labels(spark, sf):
    padded = labels.pad_batches(_batches(spark, sf))
    return padded.withColumn("labels", labels.unmask_labels(F.col("labels"))).select("row_id", _joined("labels"))


# Metrics


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score(t.pairs(spark, sf))


@_query
def edit_distance(spark, sf):
    return scoring.with_distance(_strict_pairs(spark, sf)).select(*_PAIR_KEY, "ref_words", "edits")


_COUNTS = ["ref_words", "edits", "substitutions", "deletions", "insertions", "hits"]


@_query
def edit_counts(spark, sf):
    return _scored(spark, sf).select(*_PAIR_KEY, *_COUNTS)


@_query
def corpus_wer(spark, sf):
    return _rounded(scoring.corpus_wer(_scored(spark, sf)), "wer")


@_query
def corpus_edit_totals(spark, sf):
    return scoring.corpus_edit_totals(_scored(spark, sf))


@_query
def wer_by_language(spark, sf):
    return _rounded(scoring.wer_by_language(_scored(spark, sf)), "wer")


@_query
def train_metric_wer(spark, sf):
    """References and hypotheses as padded label ids, as a training step sees them."""
    rows = t.pairs(spark, sf)
    normal = [text.word_tokens(text.norm_basic(F.col(c))) for c in ("reference", "hypothesis")]
    vocab = checkpointed(labels.build_vocab(rows, normal[0], PAIR_VOCAB_SIZE))
    encode = labels.word_encoder(vocab)
    ids = rows.select(
        *_PAIR_KEY,
        F.concat(F.array(F.lit(1)), encode(normal[0]), F.array(F.lit(2))).alias("labels"),
        encode(normal[1]).alias("predicted"),
    )
    masked = labels.strip_bos(labels.pad_batches(labels.assign_batches(ids, _PAIR_KEY)))
    return _rounded(evaluation.train_metric_wer(masked, vocab), "wer")


@_query
def best_checkpoint(spark, sf):
    return checkpoints.best_checkpoint(t.metrics(spark, sf))


@_query
def retained_checkpoints(spark, sf):
    return checkpoints.retained_checkpoints(t.metrics(spark, sf))


# User functions


def _stub_transcriber():
    """Stands in for a model: repeats the text, mishearing every ninth word."""

    def transcribe(batch: pd.DataFrame) -> pd.DataFrame:
        heard = [
            " ".join("uh" if i % 9 == 4 else w for i, w in enumerate(line.split(" "))) for line in batch["reference"]
        ]
        return batch.assign(hypothesis=heard)

    return transcribe


def _unheard(spark: SparkSession, sf: str) -> DataFrame:
    return t.pairs(spark, sf).select(*_PAIR_KEY, "audio_path", "reference")


@_query
def map_batches(spark, sf):
    schema = "conv_id long, turn long, audio_path string, reference string, hypothesis string"
    mapped = batchmap.map_batches(_unheard(spark, sf), _stub_transcriber, schema)
    return mapped.select(*_PAIR_KEY, "hypothesis")


@_query
def transcribe_and_score(spark, sf):
    scored = evaluation.transcribe_and_score(_unheard(spark, sf), t.recorded(spark, sf), _stub_transcriber)
    return scored.select(*_PAIR_KEY, *_COUNTS)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
