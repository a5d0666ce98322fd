"""Toxicity: maximum-scoring segments of token log-odds, and the extreme-value statistics of their scores."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueloom.llm.common import hash_sample, pieces_of, stored

# Tokens are runs of letters, lower-cased.
_TOKEN = re.compile(r"[^\W\d_]+")

#: A token is known by itself and by its first 4 to 8 letters, so that inflected forms share their evidence.
PREFIXES = (4, 5, 6, 7, 8)
#: Letters of a token that is a feature of its own; longer ones only have their prefixes.
LONGEST = 32

#: A feature of fewer toxic documents than this teaches nothing.
LEAST_DOCUMENTS = 3
#: Dirichlet prior: so many documents of each label, spread as the feature is over both labels, and a floor.
PRIOR, PRIOR_FLOOR = 2.0, 0.5
#: Standard errors by which a log-odds must exceed zero, as a share of the largest that chance alone gives among
#: m features, sqrt(2 ln m); what is left beyond them is the score.
CHANCE_SHARE = 0.75
#: What every token costs, so that the expected score of a clean text is negative.
COST = 0.05
#: Features of a model, the ones of the most toxic documents if there are more. They are broadcast.
FEATURES = 100_000
#: Labelled documents that teach, about; chosen by a hash of their id if there are more.
TRAINING_ROWS = 40_000
#: Those of them, about, from which the extreme-value law and the final odds are fitted.
CALIBRATION_ROWS = 20_000
#: Each of these parts of the labelled documents is judged, for that fit, by what the other parts teach.
PARTS = 4
#: Expected number of chance segments in a clean text at which one is still called significant.
SIGNIFICANT = 0.05

_FLUSH = 200_000
_MOST_EVIDENCE = 400.0


def features(token: str) -> list[str]:
    """A token's prefixes, and the token itself with an end mark."""
    found = [token[:k] for k in PREFIXES if len(token) > k]
    if len(token) <= LONGEST:
        found.append(token + "$")
    return found


def _shorter(feature: str) -> str | None:
    """The longest prefix that a feature continues."""
    letters = feature.removesuffix("$")
    size = min(len(letters) - 1, PREFIXES[-1])
    return letters[:size] if size >= PREFIXES[0] else None


def without_main(counts: dict[str, np.ndarray], others: dict[str, np.ndarray]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Counts of each feature in both labels, of a prefix without the continuation that most of its documents have.

    What one word is known for says nothing of other words that begin like it;
    a prefix counts by the variety behind it.
    """
    main: dict[str, str] = {}
    for name in sorted(counts):
        prefix = _shorter(name)
        if prefix in counts and (prefix not in main or counts[name].sum() > counts[main[prefix]].sum()):
            main[prefix] = name
    none = np.zeros(PARTS, np.int64)
    found = {}
    for name, n in counts.items():
        m = others.get(name, none)
        if name in main:
            n, m = n - counts[main[name]], m - others.get(main[name], none)
        found[name] = (n, m)
    return found


class _TokenScores(dict):
    """Score of every token met: that of its feature that speaks most for label 1; zero if none does."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, token: str) -> float:
        value = max((self.weights.get(f, 0.0) for f in features(token)), default=0.0)
        if len(self) >= _FLUSH:
            self.clear()
        self[token] = value
        return value


@dataclass
class ToxicityModel:
    """Scores of features above zero, the law of chance segments, and how evidence becomes a probability."""

    weights: dict[str, float]
    rate: float = 1.0
    scale: float = 1.0
    slope: float = 0.0
    offset: float = 0.0

    def __post_init__(self):
        self.scores = _TokenScores(self.weights)

    def token_scores(self, tokens: list[str]) -> np.ndarray:
        """Score of each token, less the cost. The k-th occurrence of a token earns a k-th of its score.

        A text that repeats one word over and over says little more by it.
        """
        values = np.fromiter(map(self.scores.__getitem__, tokens), np.float64, len(tokens))
        seen: dict[str, int] = {}
        for i in np.flatnonzero(values).tolist():
            token = tokens[i]
            times = seen[token] = seen.get(token, 0) + 1
            values[i] /= times
        return values - COST

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens, and every maximal scoring segment as (start, end, score), in text order."""
        tokens = _TOKEN.findall(text)
        found = maximal_segments(self.token_scores(tokens)) if self.weights else []
        if not found:
            return len(tokens), []
        spans = [match.span() for match in _TOKEN.finditer(text)]
        return len(tokens), [(spans[first][0], spans[last][1], score) for first, last, score in found]

    def expected(self, score: float, tokens: int) -> float:
        """Expected number of segments of at least this score in a clean text of so many tokens (Karlin and Altschul)."""
        return self.scale * tokens * math.exp(-min(self.rate * score, 700.0))

    def evidence(self, tokens: int, scores: list[float]) -> float:
        """Minus the log of the chance that a clean text has segments like its best ones.

        For each r, the r best normalised scores add up to t with probability
        ``exp(-t) t^(r-1) / (r! (r-1)!)``; the r of the least chance counts, with
        a factor of 2^r for having tried.
        """
        best, t, logs = 0.0, 0.0, 0.0
        for r, score in enumerate(sorted(scores, reverse=True), 1):
            share = self.rate * score - math.log(self.scale * tokens)
            if share <= 0:
                break
            t += share
            logs += math.log(r) + (math.log(r - 1) if r > 1 else 0.0)
            best = max(best, t + logs - (r - 1) * math.log(t) - r * math.log(2))
        return min(best, _MOST_EVIDENCE)

    def probability(self, evidence: float) -> float:
        x = self.slope * math.sqrt(evidence) + self.offset
        return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, in order, as (first, last, score), in one pass (Ruzzo and Tompa).

    Each positive score starts a segment, which is joined to the nearest earlier
    one that it extends to a higher total. The running total is kept at both ends
    of each segment, and with each the place of the nearest earlier one that
    begins lower: a search leaps over all between, which begin no lower.
    """
    totals = np.cumsum(scores)
    # first, last, total before, total after, nearest that begins lower (-1 if none)
    stack: list[tuple[int, int, float, float, int]] = []
    for last in np.flatnonzero(scores > 0).tolist():
        first, left, right = last, float(totals[last] - scores[last]), float(totals[last])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((first, last, left, right, j))
    return [(first, last, right - left) for first, last, left, right, _ in stack]


def _lower(text: str | None) -> str:
    return (text or "").lower()


def _columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def _feature_counts(docs: DataFrame, only: dict[str, int] | None = None) -> DataFrame:
    """``feature, n``: in how many documents of each part a feature occurs; those in ``only`` if it is given.

    Counted in every task first, and emptied before it grows large.
    """
    shared = docs.sparkSession.sparkContext.broadcast(only)
    places = [f"n{i}" for i in range(PARTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, counts = shared.value, {}

        def out() -> pa.RecordBatch:
            table = np.array(list(counts.values()), np.int64).reshape(-1, PARTS)
            arrays = [pa.array(list(counts), pa.string()), *[pa.array(table[:, i]) for i in range(PARTS)]]
            counts.clear()
            return pa.RecordBatch.from_arrays(arrays, ["feature", *places])

        for batch in pieces_of(batches):
            for text, part in zip(*_columns(batch, "text", "part"), strict=True):
                found = {f for token in set(_TOKEN.findall(_lower(text))) for f in features(token)}
                for f in found if wanted is None else found & wanted.keys():
                    held = counts.get(f)
                    if held is None:
                        held = counts[f] = [0] * PARTS
                    held[part] += 1
                if len(counts) >= _FLUSH:
                    yield out()
        yield out()

    counted = docs.select("text", "part").mapInArrow(run, "feature string, " + ", ".join(f"{p} long" for p in places))
    return counted.groupBy("feature").agg(*[F.sum(p).alias(p) for p in places])


def log_odds(toxic: int, clean: int, toxic_docs: int, clean_docs: int) -> tuple[float, float]:
    """Log-odds ratio of a feature between the labels under an informative Dirichlet prior, and its standard error.

    The prior has PRIOR documents of each label, in which the feature is as
    frequent as in both labels together, and at least PRIOR_FLOOR with it.
    """
    share = (toxic + clean) / (toxic_docs + clean_docs)
    with_it = max(PRIOR * share, PRIOR_FLOOR)
    without = max(PRIOR * (1 - share), PRIOR_FLOOR)
    a, b = toxic + with_it, clean + with_it
    ratio = math.log(a / (toxic_docs - toxic + without)) - math.log(b / (clean_docs - clean + without))
    return ratio, math.sqrt(1 / a + 1 / b)


def _weights(known: DataFrame) -> tuple[dict[str, float], list[dict[str, float]]]:
    """Lower bounds of the log-odds of all features that speak for label 1; and without each of the parts.

    Candidates come from the toxic documents; only they are counted in the others.
    """
    toxic, clean = known.where("label = 1"), known.where("label = 0")
    places = [F.col(f"n{i}") for i in range(PARTS)]
    total = sum(places[1:], places[0])
    frequent = _feature_counts(toxic).withColumn("n", total).where(F.col("n") >= LEAST_DOCUMENTS)
    best = _tabled(frequent.orderBy(F.desc("n"), "feature").limit(FEATURES).drop("n"))
    sizes = np.zeros((2, PARTS), np.int64)
    for row in known.groupBy("label", "part").count().collect():
        sizes[row["label"], row["part"]] = row["count"]
    there = _tabled(_feature_counts(clean, dict.fromkeys(best, 1)))
    errors = CHANCE_SHARE * math.sqrt(2 * math.log(max(len(best), 2)))
    counted = without_main(best, there)

    def bounds(used: np.ndarray) -> dict[str, float]:
        toxic_docs, clean_docs = (int(n) for n in (sizes * used).sum(axis=1)[::-1])
        found = {}
        for name, (toxic, clean) in counted.items():
            n = int(toxic @ used)
            if n >= LEAST_DOCUMENTS:
                ratio, error = log_odds(n, int(clean @ used), toxic_docs, clean_docs)
                if ratio - errors * error > COST:
                    found[name] = ratio - errors * error
        return found

    every = np.ones(PARTS, np.int64)
    return bounds(every), [bounds(every - np.eye(PARTS, dtype=np.int64)[i]) for i in range(PARTS)]


def _tabled(counted: DataFrame) -> dict[str, np.ndarray]:
    """Counts by feature. At most FEATURES rows come."""
    table = counted.toArrow()
    counts = np.stack([table[f"n{i}"].to_numpy() for i in range(PARTS)], axis=1)
    return dict(zip(table["feature"].to_pylist(), counts, strict=True))


def chance_rate(scores: np.ndarray, counts: np.ndarray) -> float:
    """The rate of the extreme-value law: the positive root of ``sum p(s) exp(rate * s) = 1`` over clean token scores."""
    share = counts / counts.sum()
    if scores.max(initial=-1.0) <= 0 or share @ scores >= 0:
        return 1.0
    value = lambda rate: share @ np.exp(rate * scores) - 1
    high = 1.0
    while value(high) < 0:
        high *= 2
    low = high
    while value(low) >= 0 and low > 1e-9:
        low /= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return (low + high) / 2


def _logistic(evidence: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (not below zero) by the root of the evidence and offset of the log-odds of label 1, by Newton steps with a weak prior on both."""
    x = np.stack((np.sqrt(evidence), np.ones(len(evidence))), axis=1)
    w, prior = np.array([0.1, 0.0]), np.diag([1e-3, 1e-3])
    loss = lambda w: np.logaddexp(0, x @ w).sum() - labels @ (x @ w) + w @ prior @ w / 2
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (p - labels) + prior @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + prior, slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return max(float(w[0]), 0.0), float(w[1])


def _calibrated(known: DataFrame, weights: dict[str, float], without: list[dict[str, float]]) -> ToxicityModel:
    """A model with the law of chance segments and the final odds, from a bounded sample of the labelled documents.

    A document's segments are those found without its part, as no text to come has taught its own words either.
    """
    model = ToxicityModel(weights)
    shared = known.sparkSession.sparkContext.broadcast(without)
    schema = "label int, tokens long, scores array<double>, bins array<int>, counts array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [ToxicityModel(weights) for weights in shared.value]
        for batch in pieces_of(batches):
            rows = []
            for label, text, part in zip(*_columns(batch, "label", "text", "part"), strict=True):
                model = models[part]
                tokens, segments = model.segments(_lower(text))
                words = _TOKEN.findall(_lower(text)) if label == 0 else []
                bins = dict(zip(*(x.tolist() for x in np.unique(np.round(model.token_scores(words) * 64).astype(int), return_counts=True)), strict=True))
                best = sorted((s[2] for s in segments), reverse=True)[:_SAMPLED_SEGMENTS]
                rows.append((label, tokens, best, list(bins), list(bins.values())))
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            arrays = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["label", "tokens", "scores", "bins", "counts"])

    sample = stored(hash_sample(known, CALIBRATION_ROWS, "text").mapInArrow(run, schema), "toxicity-sample")
    bins = sample.select(F.explode(F.arrays_zip("bins", "counts")).alias("b")).groupBy("b.bins").agg(F.sum("b.counts").alias("n"))
    law = np.array([(r["bins"] / 64, r["n"]) for r in bins.collect()], np.float64).reshape(-1, 2)
    if len(law):
        model.rate = chance_rate(law[:, 0], law[:, 1])
    rows = sample.select("label", "tokens", "scores").collect()
    # In clean texts scale * tokens * exp(-rate * best) has mean 1.
    clean = [(r["tokens"], max(r["scores"], default=0.0)) for r in rows if r["label"] == 0 and r["tokens"]]
    mean = sum(n * math.exp(-model.rate * s) for n, s in clean) / max(len(clean), 1)
    model.scale = 1 / mean if mean > 0 else 1.0
    evidence = np.array([model.evidence(r["tokens"], r["scores"]) for r in rows])
    model.slope, model.offset = _logistic(evidence, np.array([r["label"] for r in rows], np.float64))
    return model


# Segments of a sampled document that are returned for the fit of the odds.
_SAMPLED_SEGMENTS = 64


def train_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from labelled documents, ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0/1).

    About TRAINING_ROWS of them teach, at most FEATURES features make the model,
    and the extreme-value law and the odds are fitted on about CALIBRATION_ROWS;
    documents are chosen by a hash. A document with contradicting
    labels, a null label or a null id teaches nothing; equal texts of one label count once.
    Without documents of both labels every score is one half; without a feature
    that tells the labels apart it is about the share of label 1.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id")
    known = known.agg(F.min("label").alias("label"), F.max("label").alias("_high")).where("label = _high")
    known = known.where("label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    # The sample holds about TRAINING_ROWS small rows, so it may be broadcast.
    known = docs.select("doc_id", "text").join(F.broadcast(hash_sample(known, TRAINING_ROWS, "doc_id")), "doc_id")
    known = known.select(F.coalesce("text", F.lit("")).alias("text"), "label").distinct()
    part = F.pmod(F.xxhash64(F.lit(1), "text"), F.lit(PARTS)).cast("int")
    known = stored(known.withColumn("part", part), "toxicity-known")
    labels_there = {r["label"] for r in known.select("label").distinct().collect()}
    if labels_there != {0, 1}:
        return ToxicityModel({})
    return _calibrated(known, *_weights(known))


_PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier), ``predicted`` (1 if score >= 0.5) and ``passages``.

    ``passages`` are all significant segments of the lower-cased whole text, in
    text order: code points from ``start`` up to ``end``, score, and how many such
    segments chance alone puts in a clean text of that length (at most
    SIGNIFICANT). Null and empty texts, and texts without a letter, have no
    passage and the score of no evidence. Columns of ``docs`` named like the three
    are replaced; all others are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score", "predicted", "passages")
    at = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces_of(batches):
            scores, passages = [], []
            for text in batch.column(at).to_pylist():
                tokens, segments = model.segments(_lower(text))
                scores.append(model.probability(model.evidence(tokens, [s[2] for s in segments])))
                likely = [(*s, model.expected(s[2], tokens)) for s in segments]
                passages.append([dict(zip(_NAMES, s, strict=True)) for s in likely if s[3] <= SIGNIFICANT])
            scores = np.array(scores, np.float64)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
            more = [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(passages, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "score", "predicted", "passages"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, score double, predicted int, passages {_PASSAGES}")


_NAMES = ("start", "end", "score", "expected")
