"""Cut-offs found without sorting everything: vocabularies, exact shares, samples; and edit distances of any length."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cueloom.functions import scoring
from cueloom.functions.cues import clock_ms
from cueloom.operators import cues, dataset, labels, pairs


def _vocab(spark, texts, size):
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    found = labels.build_vocab(rows, F.split("text", " "), size).collect()
    return [(r.word, r.n, r.id) for r in sorted(found, key=lambda r: r.id)]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50, 399, 400, 401, 5000])
def test_vocabulary_equals_a_sorted_count(spark, size):
    rng = random.Random(3)
    # Few frequent words, and many of one count.
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(4000)] + [f"once{i}" for i in range(200)] + ["big"] * 5000
    counts = sorted(Counter(words).items(), key=lambda x: (-x[1], x[0]))
    rng.shuffle(words)
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)]
    expected = [(w, n, i + 4) for i, (w, n) in enumerate(counts[:size])]
    assert _vocab(spark, texts, size) == expected


def test_vocabulary_of_nothing_and_of_ties_only(spark):
    assert labels.build_vocab(spark.createDataFrame([], "text string"), F.split("text", " "), 5).collect() == []
    assert [w for w, *_ in _vocab(spark, ["d c b a e"], 3)] == ["a", "b", "c"]


@pytest.mark.parametrize("percent", [0, 1, 33, 80, 100])
def test_shares_are_exact_in_every_language(spark, percent):
    sizes = {"en": 1000, "fi": 37, "sv": 1, None: 9}
    rows = [(f"{lang}{i}", lang) for lang, n in sizes.items() for i in range(n)]
    table = spark.createDataFrame(rows, "key string, language string")
    split = {r.key: r.split for r in dataset.exact_split(table.repartition(7), ["key"], percent, seed=5).collect()}
    assert len(split) == len(rows)
    for lang, n in sizes.items():
        assert sum(split[k] == "train" for k, of in rows if of == lang) == n * percent // 100
    # The same rows whatever the partitions, and more of them with a larger share.
    again = {r.key: r.split for r in dataset.exact_split(table, ["key"], percent, seed=5).collect()}
    assert again == split
    more = {r.key: r.split for r in dataset.exact_split(table, ["key"], min(100, percent + 10), seed=5).collect()}
    assert all(more[k] == "train" for k, side in split.items() if side == "train")


def test_exact_split_does_not_shuffle_rows(spark):
    table = spark.createDataFrame([("a", "en", "payload")], "key string, language string, text string")
    assert dataset.exact_split(table.limit(0), ["key"], 50).collect() == []
    plan = dataset.exact_split(table, ["key"], 50)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and not any("text" in line for line in windows)


def test_progress_sample_returns_whole_rows(spark):
    rows = [(lang, i, f"text {lang} {i}") for lang, n in (("en", 350), (None, 120), ("fi", 5)) for i in range(n)]
    table = spark.createDataFrame(rows, "language string, key int, text string").repartition(6)
    found = sorted(((r.language or "", r.position, r.key, r.text) for r in pairs.progress_sample(table, ["key"]).collect()))
    assert found == [("", p, p, f"text None {p}") for p in (10, 110)] + [("en", p, p, f"text en {p}") for p in (10, 110, 210, 310)]


def _plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_distances_equal_the_plain_table(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda kinds: str(rng.randrange(kinds))
    sides = [[[word(k) for _ in range(rng.randrange(0, 140))] for _ in range(2)] for k in (2, 3, 20, 500) for _ in range(40)]
    for a in [s[0] for s in sides[:40]]:
        edited = [w for w in a if rng.random() > 0.1]
        edited[len(edited) // 2 : len(edited) // 2] = ["new"] * rng.randrange(3)
        sides.append([a, edited])
    sides += [[[], []], [["a"], []], [[], ["a", "b"]], [["a"] * 64, ["a"] * 65], [["a"] * 128, ["b"] * 128]]
    for a, b in sides:
        codes = {w: i for i, w in enumerate(sorted({*a, *b}))}
        assert scoring._distance([codes[w] for w in a], [codes[w] for w in b]) == _plain_distance(a, b)
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(sides)], "i int, a array<string>, b array<string>")
    found = rows.select("i", scoring.edit_distance(F.col("a"), F.col("b")).alias("d"), scoring.edit_counts(F.col("a"), F.col("b")).alias("c"))
    for r in found.collect():
        assert r.d == _plain_distance(*sides[r.i]) == r.c.edits


def test_long_pairs_and_nulls_have_a_distance(spark):
    words = [f"w{i}" for i in range(6000)]
    other = words[:1000] + ["x"] + words[1003:5000] + ["y", "z"] + words[5000:]
    rows = spark.createDataFrame(
        [(1, words, other), (2, None, ["a"]), (3, ["a"], None), (4, [None, "a"], ["b", "a"])], "i int, a array<string>, b array<string>"
    )
    found = {r.i: r.d for r in rows.select("i", scoring.edit_distance(F.col("a"), F.col("b")).alias("d")).collect()}
    assert found == {1: 5, 2: None, 3: None, 4: 1}


def test_clocks_of_any_length(spark):
    body = "1\n0000000000001:00:00,000 --> 12345678:00:00,0000005\nlate\n\n2\n1:1:1,1 --> 123456789012:0:0,0\nbeyond a long integer\n"
    files = spark.createDataFrame([("a.srt", body)], "path string, body string")
    [row] = cues.srt_cues(files).collect()
    assert (row.start_ms, row.end_ms, row.text) == (3_600_000, 12345678 * 3_600_000 + 5, "late")
    assert spark.range(1).select(clock_ms(F.lit("99999999999:00:00.000"))).first()[0] == 99999999999 * 3_600_000
