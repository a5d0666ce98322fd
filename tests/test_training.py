import pytest
from pyspark.sql import functions as F

from cueloom.operators import batchmap, checkpoints, dataset, labels
from cueloom.operators.pairs import nonempty_pairs
from cueloom.plans import evaluation, training
from cueloom.sources import datasets, listing


def rows_of_lengths(spark, seconds_and_labels):
    rows = [(i, float(s), list(range(n))) for i, (s, n) in enumerate(seconds_and_labels)]
    return spark.createDataFrame(rows, "row_id long, input_length double, labels array<int>")


def test_length_bounds_are_strict(spark):
    cases = [(0.0, 1), (0.001, 1), (29.999, 1), (30.0, 1), (1, 0), (1, 9), (1, 10), (1, 11)]
    kept = dataset.length_range(rows_of_lengths(spark, cases), max_label_length=10)
    assert sorted(r.row_id for r in kept.collect()) == [1, 2, 5]


def sentences(spark):
    rows = [(1, "b a a"), (2, "a c"), (3, ""), (4, "zebra b")]
    return spark.createDataFrame(rows, "row_id long, sentence string")


def words():
    return F.array_remove(F.split("sentence", " "), "")


def test_vocabulary_orders_by_count_then_word(spark):
    vocab = labels.build_vocab(sentences(spark), words(), 3).orderBy("id").collect()
    assert [tuple(r) for r in vocab] == [("a", 3, 4), ("b", 2, 5), ("c", 1, 6)]
    with pytest.raises(ValueError):
        labels.build_vocab(sentences(spark), words(), labels.MAX_VOCABULARY + 1)


def test_encode_and_decode(spark):
    vocab = labels.build_vocab(sentences(spark), words(), 3)
    encoded = labels.encode_labels(sentences(spark), words(), vocab)
    expected = {1: [1, 5, 4, 4, 2], 2: [1, 4, 6, 2], 3: [1, 2], 4: [1, 3, 5, 2]}
    assert {r.row_id: r.labels for r in encoded.collect()} == expected
    decoded = labels.decode_labels(encoded, vocab)
    assert {r.row_id: r.text for r in decoded.collect()} == {1: "b a a", 2: "a c", 3: "", 4: "b"}
    prefixed = labels.encode_labels(
        sentences(spark), words(), vocab, labels.language_prefix(F.lit("fi"), ["en", "fi"], 3)
    )
    assert prefixed.where("row_id = 2").first().labels == [1, 8, 9, 4, 6, 2]


def test_batches_pad_and_strip(spark):
    rows = spark.createDataFrame([(i, [1] * (1 + i % 4) + [2]) for i in range(70)], "row_id long, labels array<int>")
    batches = labels.assign_batches(rows, ["row_id"], size=32)
    sizes = {r.batch_id: r["count"] for r in batches.groupBy("batch_id").count().collect()}
    assert sizes == {0: 32, 1: 32, 2: 6}
    padded = labels.pad_batches(batches)
    assert padded.groupBy("batch_id").agg(F.countDistinct(F.size("labels")).alias("n")).where("n <> 1").count() == 0
    for before, after in zip(
        sorted(batches.collect(), key=lambda r: r.row_id), sorted(padded.collect(), key=lambda r: r.row_id)
    ):
        assert after.labels[: len(before.labels)] == before.labels
        assert set(after.labels[len(before.labels) :]) <= {-100}
    assert labels.strip_bos(padded).join(padded.withColumnRenamed("labels", "old"), "row_id").where(
        "labels <> slice(old, 2, size(old))"
    ).count() == 0


def test_one_row_without_begin_keeps_the_batch(spark):
    rows = spark.createDataFrame(
        [(1, 0, [1, 5]), (2, 0, [1, 6]), (3, 1, [1, 5]), (4, 1, [7, 5]), (5, 2, [])],
        "row_id long, batch_id long, labels array<int>",
    )
    got = {r.row_id: r.labels for r in labels.strip_bos(rows).collect()}
    assert got == {1: [5], 2: [6], 3: [1, 5], 4: [7, 5], 5: []}
    unmasked = rows.select(labels.unmask_labels(F.array(F.lit(-100), F.lit(4))).alias("x")).first().x
    assert unmasked == [0, 4]


def test_filters_run_before_encoding_and_python_once(spark):
    rows = sentences(spark).selectExpr("*", "'en' as language", "cast(row_id as double) as input_length")
    vocab = labels.build_vocab(sentences(spark), words(), 3)
    kept = training.labels_in_range(rows, vocab, 3, ["en"], 7)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("encode(") == 1 and plan.count("_compose(") == 1
    assert sorted(r.row_id for r in kept.collect()) == [2, 3, 4]


def test_metric_from_ids(spark):
    vocab = labels.build_vocab(sentences(spark), words(), 3)
    rows = spark.createDataFrame(
        [([1, 4, 5, 2, -100], [4, 6]), ([1, 3, 2, -100, -100], [4]), ([1, 4, 2, -100, -100], [0, 0])],
        "labels array<int>, predicted array<int>",
    )
    assert evaluation.train_metric_wer(rows, vocab).first().wer == 50.0


def test_split_is_stable_and_proportional(spark):
    rows = spark.range(5000).withColumn("language", F.lit("x"))
    split = dataset.train_eval_split(rows, ["id"], 80)
    share = split.where("split = 'train'").count() / 5000
    assert 0.77 < share < 0.83
    again = dataset.train_eval_split(rows.where("id < 100").repartition(3), ["id"], 80)
    assert again.join(split.withColumnRenamed("split", "old"), "id").where("split <> old").count() == 0


def pairs_table(spark):
    rows = [(" a.wav\n", "one ", "en"), ("b.wav", "two ", "fi"), ("b.wav", "two", "fi")]
    return spark.createDataFrame(rows, "media string, sentence string, language string")


def test_dataset_round_trip_keeps_copies(spark, tmp_path):
    built = dataset.build_dataset(pairs_table(spark), "media", "sentence")
    out = str(tmp_path / "data")
    datasets.write_dataset(built, out)
    loaded = datasets.load_datasets(spark, [out, f"{out}/language=fi", out])
    assert loaded.groupBy("dataset_no").count().orderBy("dataset_no").collect() == [(0, 3), (1, 2), (2, 3)]
    assert {r.audio.path for r in loaded.collect()} == {"a.wav", "b.wav"}
    assert {r.sentence for r in loaded.collect()} == {"one", "two"}
    datasets.write_dataset(built.where("language = 'fi'").limit(1), out)
    left = spark.read.parquet(out).groupBy("language").count().collect()
    assert {r.language: r["count"] for r in left} == {"en": 1, "fi": 1}


def test_a_batch_of_clips_written_again_leaves_one_copy(spark, tmp_path):
    schema, out = "language string, n int, samples array<float>", str(tmp_path / "clips")
    one = spark.createDataFrame([("en", 1, [0.5]), ("fi", 2, [1.0])], schema)
    other = spark.createDataFrame([("en", 3, [0.5])], schema)
    for rows, batch in ((one, "a"), (other, "b"), (one, "a"), (other, "b"), (other.limit(0), "b")):
        datasets.write_clips(rows, out, batch)
    found = [(r.language, r.batch, r.n) for r in spark.read.parquet(out).orderBy("n").collect()]
    assert found == [("en", "a", 1), ("fi", "a", 2), ("en", "b", 3)]
    assert [r.n for r in datasets.other_clips(spark, out, "a").collect()] == [3]


def test_files_of_a_language_do_not_grow_with_tasks(spark, tmp_path):
    rows = spark.range(4000).selectExpr("if(id % 2 = 0, 'en', 'fi') as language", "id", "array(1.0f, 2.0f) as samples")
    for tasks in (2, 40):
        datasets.write_clips(rows.repartition(tasks), str(tmp_path / f"clips{tasks}"), "0")
    files = {tasks: len(list((tmp_path / f"clips{tasks}").rglob("*.parquet"))) for tasks in (2, 40)}
    assert files[40] <= files[2] <= 4


def test_results_keep_text_as_text(spark, tmp_path):
    texts = ["007", 'say "hi", ok', "two\nlines", "1e5", "true", 'ends with \\']
    schema = "Reference string, Result string, Audio_File string, language string"
    rows = spark.createDataFrame([(t, t, "a.wav", "en") for t in texts], schema)
    datasets.write_results(rows, str(tmp_path))
    back = datasets.read_results(spark, str(tmp_path), schema)
    assert sorted(r.Reference for r in back.collect()) == sorted(texts)


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "x%20y.txt").write_text("hello\n")
    found = listing.list_objects(spark, str(tmp_path))
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in found.collect()] == [("x%20y.txt", 6)]
    body = listing.read_transcripts(spark, str(tmp_path)).first()
    assert body.body == "hello\n" and body.path == found.first().path


def _spark_listing(spark, root):
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return sorted((r.path, r.length, r.modificationTime.timestamp() // 1) for r in found.drop("content").collect())


@pytest.mark.parametrize("prefixes", [1, 3, 64])
def test_executors_list_what_spark_lists(spark, tmp_path, prefixes):
    for name in ("a/b/one.txt", "a/two+.srt", "c d/%25/three.vtt", "four", "_hidden/x", "e/.y", "e/_SUCCESS", "f/g/h/five"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)
    (tmp_path / "empty").mkdir()
    for root in (str(tmp_path), f"file://{tmp_path}", f"{tmp_path}/"):
        found = listing.list_objects(spark, root, prefixes)
        rows = sorted((r.path, r.length, r.modificationTime.timestamp() // 1) for r in found.collect())
        assert rows == _spark_listing(spark, str(tmp_path)) and len(rows) == 5
        assert found.rdd.getNumPartitions() >= min(prefixes, 4) - 1
    single = listing.list_objects(spark, str(tmp_path / "a" / "two+.srt"))
    assert [(r.path, r.length) for r in single.collect()] == [(f"file:{tmp_path}/a/two+.srt", 10)]


def test_a_listing_is_a_table_that_is_replaced(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for count in (1, 2):
        (tmp_path / "in" / f"{count}.txt").write_text("x")
        table = listing.write_listing(spark, str(tmp_path / "in"), str(tmp_path / "listed"))
        assert table.count() == listing.read_listing(spark, str(tmp_path / "listed")).count() == count
    with pytest.raises(Exception, match="no/such|No such file"):
        listing.list_objects(spark, str(tmp_path / "no/such")).collect()


def test_results_of_other_languages_stay(spark, tmp_path):
    schema = "Reference string, Result string, Audio_File string, language string"
    for language in ("en", "fi", "fi", "1"):
        datasets.write_results(spark.createDataFrame([("  a ", "b", "a.wav", language)], schema), str(tmp_path))
    back = datasets.read_results(spark, str(tmp_path), schema).collect()
    assert sorted((r.Reference, r.language) for r in back) == [("  a ", "1"), ("  a ", "en"), ("  a ", "fi")]


def test_language_is_text(spark, tmp_path):
    rows = spark.createDataFrame([("a", "s", "1"), ("b", "t", "2")], "audio string, sentence string, language string")
    datasets.write_dataset(rows, str(tmp_path / "d"))
    loaded = datasets.load_datasets(spark, [str(tmp_path / "d")], split="train")
    assert sorted((r.language, r.split) for r in loaded.collect()) == [("1", "train"), ("2", "train")]


def test_factory_runs_once_per_task(spark):
    def factory():
        seen = []

        def apply(batch):
            seen.append(len(batch))
            return batch.assign(calls=len(seen))

        return apply

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        mapped = batchmap.map_batches(spark.range(100), factory, "id long, calls long", partitions=2)
        assert mapped.agg(F.max("calls")).first()[0] == 5
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def metrics(spark):
    rows = [("r", s, float(w)) for s, w in enumerate([9, 1, 8, 1, 7, 6, 5, 4, 3, 2, 5, 6, 7, 8])] + [("q", 1, 2.0)]
    return spark.createDataFrame(rows, "run string, step long, wer double")


def test_checkpoints(spark):
    assert sorted(map(tuple, checkpoints.best_checkpoint(metrics(spark)).collect())) == [("q", 1, 2.0), ("r", 1, 1.0)]
    kept = checkpoints.retained_checkpoints(metrics(spark), 5)
    assert sorted((r.run, r.step, r.is_best) for r in kept.collect()) == [
        ("q", 1, True),
        ("r", 1, True),
        ("r", 10, False),
        ("r", 11, False),
        ("r", 12, False),
        ("r", 13, False),
    ]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


def test_nonempty_is_null_safe(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", "b")], "reference string, hypothesis string")
    assert nonempty_pairs(rows).count() == 1


def test_splits_are_batched_apart_and_labels_made_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def costly(n):
        calls.add(1)
        return [1] + [5] * (n % 4)

    rows = spark.range(100).selectExpr("id", "if(id % 3 = 0, 'eval', 'train') as split")
    rows = rows.withColumn("labels", costly.asNondeterministic()(F.col("id").cast("int")))
    batches = labels.assign_batches(rows, ["id"], size=8, by=["split"])
    found = batches.collect()
    assert calls.value == 100
    for split, n in (("train", 66), ("eval", 34)):
        places = sorted((r.batch_id, r.row_in_batch) for r in found if r.split == split)
        assert places == [(i // 8, i % 8) for i in range(n)]
    padded = labels.pad_batches(batches, by=["split"]).collect()
    widths = {}
    for r in padded:
        widths.setdefault((r.split, r.batch_id), set()).add(len(r.labels))
    assert all(len(w) == 1 for w in widths.values())
    assert all(r.labels[0] == 5 or r.labels[0] == -100 for r in labels.strip_bos(labels.pad_batches(batches, by=["split"]), by=["split"]).collect() if r.labels)


def test_null_words_are_unknown(spark):
    vocab = labels.build_vocab(spark.createDataFrame([("a a b",)], "text string"), F.split("text", " "), 5)
    rows = spark.createDataFrame([(1, ["a", None, "b", "c"]), (2, None), (3, [])], "i int, words array<string>")
    found = rows.select("i", labels.word_encoder(vocab)(F.col("words")).alias("ids")).collect()
    assert {r.i: r.ids for r in found} == {1: [4, 3, 5, 3], 2: [], 3: []}
