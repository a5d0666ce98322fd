"""Edit counts against brute force, and their invariants."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cueloom.functions import scoring as kernel
from cueloom.operators import scoring
from cueloom.operators.pairs import nonempty_pairs

WORDS = st.lists(st.integers(0, 4), max_size=12)


def brute(ref, hyp):
    """(edits, deletions) by the textbook table over tuples."""
    row = [(j, 0) for j in range(len(hyp) + 1)]
    for i, r in enumerate(ref, 1):
        new = [(i, i)]
        for j, h in enumerate(hyp, 1):
            sub = (row[j - 1][0] + (r != h), row[j - 1][1])
            new.append(min(sub, (row[j][0] + 1, row[j][1] + 1), (new[-1][0] + 1, new[-1][1])))
        row = new
    return row[-1]


def unpack(cost):
    return int(cost) >> 32, int(cost) & (2**32 - 1)


def costs(pairs):
    flat = lambda side: np.array([w for p in pairs for w in p[side]], dtype=np.int64)
    at = lambda side: np.cumsum([0] + [len(p[side]) for p in pairs])
    return [unpack(c) for c in kernel._pair_costs(flat(0), at(0), flat(1), at(1))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(WORDS, WORDS), min_size=1, max_size=8))
def test_batched_alignment_equals_brute_force(pairs):
    assert costs(pairs) == [brute(*p) for p in pairs]


@settings(max_examples=100, deadline=None)
@given(WORDS, WORDS)
def test_banded_alignment_equals_brute_force(ref, hyp):
    if ref or hyp:
        cost = kernel._banded_cost(np.array(ref, dtype=np.int64), np.array(hyp, dtype=np.int64))
        assert unpack(cost) == brute(ref, hyp)


def test_long_pairs_are_banded_exactly():
    random = np.random.default_rng(7)
    for edits in (0, 30, 500):
        ref = random.integers(0, 500, 1500)
        hyp = np.delete(ref, random.integers(0, 1500, edits))
        full = kernel._padded_costs(ref[None, :], hyp[None, :], np.array([len(ref)]), np.array([len(hyp)]))
        assert kernel._banded_cost(ref, hyp) == full[0]
        assert costs([(list(ref), list(hyp)), ([1, 2], [2])]) == [unpack(full[0]), (1, 1)]


def test_small_steps_change_nothing(monkeypatch):
    random = np.random.default_rng(3)
    words = lambda: list(random.integers(0, 9, random.integers(0, 40)))
    pairs = [(words(), words()) for _ in range(60)]
    whole = costs(pairs)
    monkeypatch.setattr(kernel, "_STEP_CELLS", 64)
    monkeypatch.setattr(kernel, "_LONE_PAIR_CELLS", 200)
    assert costs(pairs) == whole == [brute(*p) for p in pairs]


def test_wide_packing_changes_nothing(monkeypatch):
    random = np.random.default_rng(4)
    words = lambda: list(random.integers(0, 30, random.integers(0, 90)))
    pairs = [(words(), words()) for _ in range(40)]
    narrow = costs(pairs)
    monkeypatch.setattr(kernel, "_SHORT_WORDS", 0)
    assert costs(pairs) == narrow == [brute(*p) for p in pairs]


def pairs_frame(spark, rows):
    return spark.createDataFrame(rows, "language string, reference string, hypothesis string")


def test_split_of_edits(spark):
    rows = [("x", "a b c", "b c d"), ("x", "a b", "b c"), ("y", "a", "a b b"), ("y", "a b c", "c")]
    scored = scoring.with_edits(pairs_frame(spark, rows).coalesce(1))
    got = [(r.substitutions, r.deletions, r.insertions, r.hits) for r in scored.collect()]
    assert got == [(0, 1, 1, 2), (2, 0, 0, 0), (0, 0, 2, 1), (0, 2, 0, 1)]
    native = scoring.with_distance(pairs_frame(spark, rows).coalesce(1))
    assert [r.edits for r in native.collect()] == [2, 2, 2, 2]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text("ab c", max_size=20), st.text("abc ", max_size=20)), min_size=1, max_size=20))
def test_counts_are_consistent(spark, texts):
    rows = [("x", r, h) for r, h in texts]
    counted = scoring.with_edits(pairs_frame(spark, rows)).drop("ref_words").withColumnRenamed("edits", "counted")
    for row in scoring.with_distance(counted).collect():
        n, m = len(row.reference.split()), len(row.hypothesis.split())
        assert row.counted == row.edits == row.substitutions + row.deletions + row.insertions
        assert abs(n - m) <= row.edits <= max(n, m)
        assert row.substitutions + row.deletions + row.hits == n == row.ref_words
        assert row.substitutions + row.insertions + row.hits == m


def test_nulls_score_as_empty(spark):
    rows = pairs_frame(spark, [("x", None, "a b"), ("x", "a", None)])
    assert scoring.score(rows).count() == 0


def test_rate_is_ratio_of_sums(spark):
    rows = [("x", "a b c d", "a b c d"), ("y", "a", "b"), ("y", " ", "b"), ("y", "!", "b")]
    scored = scoring.score(pairs_frame(spark, rows))
    assert scoring.corpus_wer(scored).first().wer == 20.0
    table = {r.language: (r.pairs, r.wer) for r in scoring.wer_by_language(scored).collect()}
    assert table == {"x": (1, 0.0), "y": (1, 100.0), None: (2, 20.0)}
    nothing = scoring.score(pairs_frame(spark, []))
    assert scoring.corpus_wer(nothing).first().wer is None


def test_score_equals_filtering_first(spark):
    rows = [("x", "A, b", "a b"), ("x", "...", "a"), ("y", "a ", "?"), ("y", " ", "b"), ("y", "q r", "q")]
    frame = pairs_frame(spark, rows)
    first = scoring.with_edits(scoring.normalised(frame))
    assert sorted(scoring.score(frame).collect()) == sorted(first.collect())


def test_blank_counts_as_empty_only_if_asked(spark):
    frame = pairs_frame(spark, [("x", " ", "a"), ("x", "a", "b"), ("x", "", "b"), ("x", None, "b")])
    assert nonempty_pairs(frame).count() == 1
    assert nonempty_pairs(frame, blank_is_empty=False).count() == 2
