"""Toxicity: segments against all ranges, the chance law against simulation, and scores on planted words."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cueloom.llm.toxicity import (
    COST,
    LEAST_DOCUMENTS,
    SIGNIFICANT,
    ToxicityModel,
    chance_rate,
    features,
    log_odds,
    maximal_segments,
    score_toxicity,
    train_toxicity,
    without_main,
)

MILD = [a + b for a in ("ba", "de", "fi", "go", "hu") for b in ("lan", "mor", "net", "pir", "ste", "tul")]
VILE = ["scumbag", "wretch", "vermin"]


def _text(rng, words, vile=0):
    found = rng.choices(MILD, k=words)
    for _ in range(vile):
        found.insert(rng.randrange(len(found) + 1), rng.choice(VILE))
    return " ".join(found).capitalize() + "."


def _corpus(count, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(count):
        toxic = int(rng.random() < 0.3)
        docs.append((i, _text(rng, rng.randrange(20, 200), 3 if toxic else 0)))
        labels.append((i, toxic))
    return docs, labels


def _maximal(scores):
    """All maximal scoring segments by their definition: the best range, shortest first, then the same on both its sides."""
    ranges = ((sum(scores[i:j]), i - j, -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))
    best = max(ranges, default=(0, 0, 0))
    if best[0] <= 1e-12:
        return []
    start, end = -best[2], -best[2] - best[1]
    return _maximal(scores[:start]) + [(start, end, best[0])] + [(a + end, b + end, s) for a, b, s in _maximal(scores[end:])]


@pytest.mark.parametrize("seed", range(20))
def test_segments_equal_all_ranges(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-3, -2, -1, 1, 2, 3]) / 4 for _ in range(40)]
    found = maximal_segments(np.array(scores))
    assert [(a, b + 1, s) for a, b, s in found] == _maximal(scores)


def test_passages_are_places_in_the_lower_cased_text():
    model = ToxicityModel({"scum$": 2.0, "vile$": 2.0})
    text = "A fine day, SCUM and Vile \u00e9t\u00e9!".lower()
    assert model.segments(text) == (7, [(12, 25, pytest.approx(4 - 3 * COST))])
    assert text[12:25] == "scum and vile"


def test_repeated_tokens_earn_less_and_long_texts_take_linear_time():
    model = ToxicityModel({"scum$": 2.0})
    [(start, end, score)] = model.segments("scum " * 10)[1]
    earned = [2.0 / k - COST for k in range(1, 11)]
    assert score == pytest.approx(sum(earned)) and (start, end) == (0, 49)
    rng = random.Random(1)
    text = " ".join(rng.choices(["scum", "fine", "scums"], k=300_000))
    assert model.segments(text)[0] == 300_000
    # Totals that fall, rise and stay level, with many segments open.
    for scores in ([1, -2], [2, -1], [1, -1]):
        assert maximal_segments(np.tile(np.array(scores, float), 300_000))


def test_features_and_their_counts():
    assert features("idiot") == ["idio", "idiot$"]
    assert features("ab") == ["ab$"] and features("x" * 40) == ["x" * k for k in (4, 5, 6, 7, 8)]
    # "lose" is known for "loser" alone; "bomb" for several words.
    counts = {"lose": [9], "loser$": [8], "bomb": [9], "bombe": [3], "bomba": [3], "bomby$": [3]}
    counts = {k: np.array(v * 4) for k, v in counts.items()}
    left = without_main(counts, {"lose": np.array([2] * 4), "loser$": np.array([1] * 4)})
    assert left["lose"][0].tolist() == [1] * 4 and left["lose"][1].tolist() == [1] * 4
    assert left["bomb"][0].tolist() == [6] * 4 and left["loser$"][0].tolist() == [8] * 4


def test_log_odds_shrink_with_little_evidence():
    few, many = log_odds(3, 0, 100, 100), log_odds(60, 0, 100, 100)
    assert 0 < few[0] < many[0] and few[1] > 0.3
    assert abs(log_odds(50, 50, 100, 100)[0]) < 1e-9
    assert log_odds(1, 9, 100, 100)[0] == pytest.approx(-log_odds(9, 1, 100, 100)[0])


def test_chance_law_holds_in_simulated_clean_texts():
    scores, share = np.array([-0.5, 1.0, 2.0]), np.array([0.8, 0.15, 0.05])
    rate = chance_rate(scores, share * 1000)
    assert share @ np.exp(rate * scores) == pytest.approx(1)
    rng = np.random.default_rng(1)
    best = []
    for _ in range(2000):
        total = np.concatenate(([0], np.cumsum(rng.choice(scores, 400, p=share))))
        best.append((total - np.minimum.accumulate(total)).max())
    best = np.array(best)
    # Two points of the tail differ by exp(-rate * difference).
    ratio = (best >= 9).mean() / (best >= 7).mean()
    assert ratio == pytest.approx(math.exp(-rate * 2), rel=0.25)
    assert chance_rate(np.array([-1.0]), np.array([5.0])) == 1.0


def test_evidence_grows_with_scores_and_passages_and_falls_with_length():
    model = ToxicityModel({"x": 1.0}, rate=1.0, scale=0.1)
    assert model.evidence(0, []) == model.evidence(100, []) == 0
    assert model.evidence(100, [8.0]) > model.evidence(100, [6.0]) > model.evidence(1000, [6.0])
    assert model.evidence(100, [6.0, 6.0, 6.0]) > model.evidence(100, [6.0, 6.0]) > model.evidence(100, [6.0])
    assert model.expected(6.0, 100) == pytest.approx(0.1 * 100 * math.exp(-6))


def test_planted_words_are_learned_found_and_calibrated(spark):
    docs, labels = _corpus(600, seed=1)
    model = train_toxicity(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, label int")
    )
    assert set(VILE) <= {w.removesuffix("$") for w in model.weights}
    tests, truth = _corpus(400, seed=2)
    scored = score_toxicity(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()
    texts, truth = dict(tests), dict(truth)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in scored) >= 396
    for r in scored:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert all(p["expected"] <= SIGNIFICANT for p in r["passages"])
        # Each vile word lies in a passage.
        covered = [texts[r["doc_id"]].lower()[p["start"] : p["end"]] for p in r["passages"]]
        if truth[r["doc_id"]]:
            assert any(v in c for c in covered for v in VILE)


def test_odd_rows_and_clashing_columns(spark):
    docs, labels = _corpus(200, seed=3)
    odd = [(None, docs[0][1]), (1000, None), (1001, ""), (1002, "123 !?"), (1003, "x" * 200_000), (1004, " ".join(MILD * 3000 + VILE * 2))]
    odd += [docs[5], docs[5]]
    labels += [(None, 1), (1000, 1), (1001, None), (5, 1 - dict(labels)[5])]
    table = spark.createDataFrame(docs + odd, "doc_id long, text string")
    for name in ("score", "predicted", "passages", "label", "part", "n", "feature", "my col`"):
        table = table.withColumn(name.replace("`", ""), F.lit("kept"))
    model = train_toxicity(table, spark.createDataFrame(labels, "doc_id long, label int"))
    scored = score_toxicity(table, model)
    assert scored.columns[-3:] == ["score", "predicted", "passages"] and "my col" in scored.columns
    rows = scored.collect()
    assert len(rows) == len(docs) + len(odd)
    by = {r["doc_id"]: r for r in rows}
    assert by[1000]["score"] == by[1001]["score"] == by[1002]["score"] < 0.5
    assert not by[1000]["passages"] and by[1004]["passages"]
    assert len([r for r in rows if r["doc_id"] == 5]) == 3


def test_empty_tables_and_one_label(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, label int")
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(9)], "doc_id long, text string")
    for model in (train_toxicity(none, labels), train_toxicity(docs, labels), train_toxicity(docs, labels.limit(0))):
        assert {r["score"] for r in score_toxicity(docs, model).collect()} == {0.5}
        assert score_toxicity(none, model).count() == 0
    mixed = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, label int")
    model = train_toxicity(docs, mixed)
    assert not model.weights and LEAST_DOCUMENTS > 1
    [score] = {round(r["score"], 6) for r in score_toxicity(docs, model).collect()}
    assert score == pytest.approx(4 / 9, abs=0.1)
