import random

import pytest
from pyspark.sql import functions as F

from cueloom.errors import ManifestError
from cueloom.operators import manifest
from cueloom.plans.acquisition import acquisition_plan, cutting_plan, run_summary
from cueloom.sources.manifest import read_manifest

COLUMNS = {"media_file": "media_path", "transcript_file": "transcript_path"}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (1, "a.mp4", "a.srt", "en"),
            (2, "a.wav", "b.vtt", "fi"),
            (3, None, "c.srt", "en"),
            (4, "gone.wav", "a.srt", "en"),
            (5, "b.wav", "secret.srt", "sv"),
            (6, "d.wav", "d.txt", "sv"),
        ],
        "manifest_id long, media_file string, transcript_file string, language string",
    )


@pytest.fixture(scope="module")
def listing(spark):
    names = ["x/a.mp4", "x/ba.wav", "y/a.wav", "x/a.srt", "b.vtt", "z/b.wav", "me@x.org/secret.srt", "d.wav", "d.txt"]
    return spark.createDataFrame([(n,) for n in names], "path string")


def table(df, *columns):
    return {r["manifest_id"]: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("filter_bits", [64, 100, manifest.FILTER_BITS])
def test_resolve_by_suffix_with_any_filter(spark, rows, listing, filter_bits):
    resolved = manifest.resolve_names(rows, listing, COLUMNS, filter_bits)
    assert table(resolved, "media_path", "transcript_path") == {
        1: ("x/a.mp4", "x/a.srt"),
        2: ("x/ba.wav", "b.vtt"),
        3: (None, None),
        4: (None, "x/a.srt"),
        5: ("z/b.wav", "me@x.org/secret.srt"),
        6: ("d.wav", "d.txt"),
    }
    plan = resolved._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_resolve_exact_needs_the_whole_name(rows, listing):
    exact = manifest.resolve_exact(rows, listing, COLUMNS)
    assert table(exact, "media_path")[2] == ("y/a.wav",)


def test_exclusion_is_by_substring(spark, listing):
    left = manifest.exclude_names(listing, ["path"], emails=["me@x"], domains=["x/"])
    assert {r.path for r in left.collect()} == {"y/a.wav", "b.vtt", "z/b.wav", "d.wav", "d.txt"}
    assert manifest.exclude_names(listing, ["path"], domains=[""]).count() == 0
    assert manifest.exclude_names(listing, ["path"]).count() == listing.count()


def test_statuses_follow_precedence(spark, rows, listing):
    present = spark.createDataFrame([("l/a.wav",), ("l/a.srt",)], "path string")
    plan = acquisition_plan(rows, listing, present, emails=["me@x.org"])
    assert table(plan, "status", "transcript_present") == {
        1: ("present", True),
        2: ("to_fetch", False),
        3: ("incomplete", False),
        4: ("unresolved", True),
        5: ("excluded", False),
        6: ("to_fetch", False),
    }
    cut = cutting_plan(rows, listing, listing)
    assert table(cut, "status") == {
        1: ("to_cut",),
        2: ("to_cut",),
        3: ("incomplete",),
        4: ("missing",),
        5: ("to_cut",),
        6: ("unsupported",),
    }
    counts = {(r.stage, r.status): r.n for r in run_summary({"acquire": plan, "cut": cut}).collect()}
    assert counts["acquire", "to_fetch"] == 2 and counts["cut", "to_cut"] == 3


def test_skip_and_exist(spark, rows, listing):
    present = spark.createDataFrame([("l/a.wav",)], "path string")
    resolved = manifest.resolve_names(rows, listing, COLUMNS)
    assert set(table(manifest.skip_present(resolved, present), "language")) == {2, 3, 4, 5, 6}
    assert set(table(manifest.both_files_exist(rows, listing, listing), "language")) == {1, 2, 5, 6}
    assert set(table(manifest.supported_only(rows), "language")) == {1, 2, 3, 4, 5}
    assert set(table(manifest.manifest_complete(rows), "language")) == {1, 2, 4, 5, 6}


def test_results_do_not_depend_on_partitioning(rows, listing):
    one = manifest.resolve_names(rows.coalesce(1), listing.coalesce(1), COLUMNS)
    many = manifest.resolve_names(rows.repartition(7), listing.repartition(5), COLUMNS)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_read_manifest(spark, rows, tmp_path):
    rows.write.option("header", True).csv(str(tmp_path / "m"))
    assert sorted(map(str, read_manifest(spark, str(tmp_path / "m")).collect())) == sorted(map(str, rows.collect()))
    rows.where(F.lit(False)).write.parquet(str(tmp_path / "none"))
    with pytest.raises(ManifestError):
        read_manifest(spark, str(tmp_path / "none"), "parquet")
    with pytest.raises(ManifestError):
        read_manifest(spark, str(tmp_path / "missing"))


def test_manifest_columns_go_by_name(spark, tmp_path):
    sheet = 'Language,Audio/Video,Transcript\nen,"my, ""talk"".wav",a.srt\nfi,b.mp4,"two\nlines.srt"\n'
    (tmp_path / "m.csv").write_text(sheet)
    names = {"media_file": "Audio/Video", "transcript_file": "Transcript", "language": "Language"}
    rows = read_manifest(spark, str(tmp_path / "m.csv"), columns=names).collect()
    assert {r[1:] for r in rows} == {('my, "talk".wav', "a.srt", "en"), ("b.mp4", "two\nlines.srt", "fi")}
    assert len({r.manifest_id for r in rows}) == 2
    with pytest.raises(ManifestError):
        read_manifest(spark, str(tmp_path / "m.csv"))


def _left(spark, names, texts, **options):
    rows = spark.createDataFrame([(n, None) for n in names], "path string, other string")
    listed = spark.createDataFrame([(x,) for x in texts], "pattern string")
    return sorted(repr(r.path) for r in manifest.exclude_listed(rows, ["path", "other"], listed, **options).collect())


@pytest.mark.parametrize("max_texts", [0, 10**6])
def test_long_exclusion_lists_equal_contains(spark, max_texts):
    rng = random.Random(7)
    names = ["".join(rng.choices("ab@.\U0001f600é", k=rng.randrange(0, 30))) for _ in range(300)] + [None, "", "a", "same", "same"]
    texts = ["".join(rng.choices("ab@.\U0001f600é", k=rng.randrange(1, 9))) for _ in range(60)] + [None, "z", "z", "x" * 50]
    texts = [x for x in texts if x is None or len(x) > 3 or x == "z"]
    expected = sorted(repr(n) for n in names if n is None or not any(x in n for x in texts if x is not None))
    assert _left(spark, names, texts, max_texts=max_texts) == expected
    assert 0 < len(expected) < len(names)


@pytest.mark.parametrize("max_texts", [0, 10**6])
def test_exclusion_lists_that_are_empty_or_hold_an_empty_text(spark, max_texts):
    assert _left(spark, ["a", None, ""], [], max_texts=max_texts) == sorted(["'a'", "None", "''"])
    assert _left(spark, ["a", None, ""], ["", "b"], max_texts=max_texts) == ["None"]


def test_many_listed_texts_of_one_head_cost_no_more():
    listed = manifest.ListedTexts([f"user{i}@mail.org" for i in range(100_000)])
    names = [f"in/user{i}@mail.com/user{i}@mail.orx/{i}.wav" for i in range(20_000)]
    assert not any(map(listed.found_in, names))
    assert listed.found_in("x/user99999@mail.org.wav") and listed.found_in(None) is None


def test_endings_that_match_nothing_are_not_shuffled(spark):
    names = spark.range(20_000).selectExpr("concat('rec_', id * 7, '.wav') as name")
    listing = spark.range(50_000).selectExpr("concat('store/', id % 13, '/rec_', id, '.wav') as path")
    passed = manifest.path_endings(names, listing)
    exact = listing.count() // 7 + 1
    assert exact <= passed.count() <= exact * 1.2  # of some 250,000 endings
    assert manifest.name_filter(names, 6400).count() == 100
    spark.sparkContext.setJobGroup("resolving", "")
    manifest.resolve_names(names.withColumnRenamed("name", "a"), listing, {"a": "path"})
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("resolving")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = passed.select("name").groupBy("name").count()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("max_texts", [0, 10**6])
def test_flags_of_listed_texts_keep_all_rows(spark, max_texts):
    rows = spark.createDataFrame([("x/a", None), ("x/a", None), (None, "b/c"), (None, None), ("q", "q")], "a string, b string")
    texts = spark.createDataFrame([("x/",), ("c",), (None,)], "text string")
    flagged = manifest.flag_listed(rows, ["a", "b"], texts, "listed", max_texts)
    assert flagged.columns == ["a", "b", "listed"]
    assert sorted(map(str, flagged.collect())) == sorted(
        f"Row(a={a!r}, b={b!r}, listed={hit})"
        for a, b, hit in [("x/a", None, True), ("x/a", None, True), (None, "b/c", True), (None, None, False), ("q", "q", False)]
    )


def test_plan_with_a_long_exclusion_list(spark, rows, listing):
    present = spark.createDataFrame([("l/a.wav",)], "path string")
    texts = spark.createDataFrame([("me@x",), ("nowhere",)], "text string")
    plan = acquisition_plan(rows, listing, present, excluded_texts=texts)
    short = acquisition_plan(rows, listing, present, emails=["me@x", "nowhere"])
    assert plan.columns == short.columns
    assert sorted(map(str, plan.collect())) == sorted(map(str, short.collect()))
