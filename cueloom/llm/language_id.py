"""Language ID by prediction by partial matching: code lengths under byte context trees with escapes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueloom.llm.common import as_list, pieces_of

UNDETERMINED = "und"
#: Training documents a language, at most about; whole texts are learned from.
TRAINING_ROWS = 800
#: A context of three bytes is a node of the trees if the training texts have it so often.
LEAST_SEEN = 12
_ORDER = 3
_PAD = b"\n" * _ORDER
_LETTER = re.compile(r"[^\W\d_]")
_AT_ONCE = 1 << 20


@dataclass
class LanguageTree:
    """Frozen statistics of one language: bits of the bytes seen after a context, and of the escape from it.

    Contexts are numbers of up to three bytes, a byte after one is ``256 * context +
    byte``. ``short`` holds the bits of every byte after each single byte, escapes
    included. Longer contexts list only what was seen: sorted numbers and their
    bits. A context without an entry costs nothing to escape from.
    """

    short: np.ndarray
    pairs: np.ndarray
    pair_bits: np.ndarray
    pair_escape: np.ndarray
    triples: np.ndarray
    triple_bits: np.ndarray
    contexts: np.ndarray
    context_escape: np.ndarray

    def bits_of(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each 4-byte string after the three before it."""
        bits = self.short[grams & 0xFFFF]
        bits = _longer(grams & 0xFFFFFF, self.pairs, self.pair_bits, self.pair_escape[grams >> 8 & 0xFFFF] + bits)
        escape = _longer(grams >> 8, self.contexts, self.context_escape, np.zeros(len(grams), np.float32))
        return _longer(grams, self.triples, self.triple_bits, escape + bits)


def _longer(wanted: np.ndarray, known: np.ndarray, values: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
    """The value of each wanted number that is known (sorted), else what ``otherwise`` has."""
    if not len(known):
        return otherwise
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, values[at], otherwise)


@dataclass
class ContextTrees:
    """The trees of all languages. A language takes half a megabyte and 12 bytes for each context and byte it was seen with."""

    languages: list[str] = field(default_factory=list)
    trees: list[LanguageTree] = field(default_factory=list)

    @property
    def nbytes(self) -> int:
        return sum(getattr(tree, f.name).nbytes for tree in self.trees for f in fields(tree))

    @property
    def bits(self) -> np.ndarray:
        """``[context, byte, language]`` in full, to look at small trees: all contexts of two bytes that some language has, then
        all of three. The last byte stands for one that no language has."""
        met = np.unique(np.concatenate([t.pairs & 255 for t in self.trees] + [t.pairs >> 16 for t in self.trees]))
        unmet = np.setdiff1d(np.arange(256), met)[:1]
        pairs = np.unique(np.concatenate([t.pairs >> 8 for t in self.trees]))
        # Before a pair goes a byte that is in no context of three, if there is one.
        longer = np.unique(np.concatenate([t.contexts for t in self.trees]))
        context = np.concatenate([pairs | (unmet[0] << 16 if len(unmet) else 0), longer])
        grams = (context[:, None] << 8) | np.concatenate([met, unmet])[None, :]
        return np.stack([t.bits_of(grams.ravel()).reshape(grams.shape) for t in self.trees], axis=2)

    def lengths_of(self, texts: list[bytes]) -> np.ndarray:
        """A row for each text: bits of the whole text in each language. A text starts after three line feeds."""
        out = np.zeros((len(texts), len(self.languages)))
        at = 0
        while at < len(texts):
            upto, size = at + 1, len(texts[at])
            while upto < len(texts) and size + len(texts[upto]) <= _AT_ONCE:
                size += len(texts[upto])
                upto += 1
            if upto > at + 1:
                out[at:upto] = self._sums([_PAD + text for text in texts[at:upto]])
            else:
                text = _PAD + texts[at]
                for start in range(0, max(1, len(texts[at])), _AT_ONCE):
                    out[at] += self._sums([text[start : start + _AT_ONCE + _ORDER]])[0]
            at = upto
        return out

    def _sums(self, padded: list[bytes]) -> np.ndarray:
        raw = np.frombuffer(b"".join(padded), np.uint8).astype(np.int64)
        sizes = np.array([len(text) - _ORDER for text in padded])
        grams = ((raw[:-3] << 8 | raw[1:-2]) << 8 | raw[2:-1]) << 8 | raw[3:]
        inside = np.ones(len(grams), bool)
        for back in range(1, _ORDER + 1):  # strings that reach into the next text
            inside[np.cumsum(sizes + _ORDER)[:-1] - back] = False
        grams, whose = np.unique(grams[inside], return_inverse=True)
        out = np.zeros((len(padded), len(self.languages)))
        some = np.flatnonzero(sizes)
        if len(some):
            starts = (np.cumsum(sizes) - sizes)[some]
            for i, tree in enumerate(self.trees):
                out[some, i] = np.add.reduceat(tree.bits_of(grams).astype(np.float64)[whose], starts)
        return out

    def code_lengths(self, text: bytes) -> np.ndarray:
        return self.lengths_of([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language of each text's shortest code, and its probability if all are equally likely before.

        Of equal code lengths the first language in order wins. ``und`` with 0
        for a null text, one without a letter, and if nothing was learned.
        """
        out = [(UNDETERMINED, 0.0)] * len(texts)
        asked = [i for i, text in enumerate(texts) if text and self.languages and _LETTER.search(text)]
        lengths = self.lengths_of([texts[i].encode("utf-8", "surrogatepass") for i in asked])
        for i, bits in zip(asked, lengths, strict=True):
            best = int(np.argmin(bits))
            out[i] = self.languages[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def _escapes(cells: np.ndarray, counts: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted ``256 * context + byte`` with their counts (PPM-C): bits of each, the contexts, and bits of their escapes.

    With n bytes of q kinds seen after a context, a seen byte has c/(n+q) and the
    escape q/(n+q), which the unseen bytes share as the shorter context has them,
    those seen excluded. ``lower`` are the bits that the shorter context gives.
    """
    contexts, at, kinds = np.unique(cells >> 8, return_index=True, return_counts=True)
    if not len(contexts):
        return np.zeros(0, np.float32), contexts, np.zeros(0, np.float32)
    total = np.add.reduceat(counts, at) + kinds
    bits = np.log2(np.repeat(total, kinds)) - np.log2(counts)
    free = np.add.reduceat(np.exp2(-lower.astype(np.float64)), at)
    escape = np.log2(np.maximum(1 - free, 1e-12)) - np.log2(kinds / total)
    return bits.astype(np.float32), contexts, escape.astype(np.float32)


def _summed(cells: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, whose = np.unique(cells, return_inverse=True)
    return known, np.bincount(whose, weights=counts, minlength=len(known))


def _tree(grams: np.ndarray, counts: np.ndarray, frequent: np.ndarray) -> LanguageTree:
    """The tree of a language's counted 4-byte strings; of three bytes only ``frequent`` contexts (sorted) count."""
    known, seen = _summed(grams & 0xFF, counts)
    bits, _, escape = _escapes(known, seen, np.full(len(known), 8.0))
    none = np.full(256, 8.0, np.float32) + escape
    none[known] = bits
    known, seen = _summed(grams & 0xFFFF, counts)
    bits, contexts, escape = _escapes(known, seen, none[known & 255])
    short = np.repeat(none[None, :], 256, axis=0)
    short[contexts] += escape[:, None]
    short = short.ravel()
    short[known] = bits
    pairs, seen = _summed(grams & 0xFFFFFF, counts)
    pair_bits, contexts, escape = _escapes(pairs, seen, short[pairs & 0xFFFF])
    pair_escape = np.zeros(1 << 16, np.float32)
    pair_escape[contexts] = escape
    kept = np.isin(grams >> 8, frequent)
    triples, seen = _summed(grams[kept], counts[kept])
    lower = pair_bits[np.searchsorted(pairs, triples & 0xFFFFFF)]  # what follows three bytes follows two
    triple_bits, contexts, escape = _escapes(triples, seen, lower)
    return LanguageTree(short, pairs, pair_bits, pair_escape, triples, triple_bits, contexts, escape)


def build_trees(languages: list[str], grams: np.ndarray, whose: np.ndarray, counts: np.ndarray, least: int = LEAST_SEEN) -> ContextTrees:
    """Trees from counted 4-byte strings: ``grams`` big-endian, ``whose`` an index into ``languages``."""
    grams, counts = grams.astype(np.int64), counts.astype(np.float64)
    contexts, seen = _summed(grams >> 8, counts)
    frequent = contexts[seen >= least]
    trees = [_tree(grams[whose == i], counts[whose == i], frequent) for i in range(len(languages))]
    return ContextTrees(list(languages), trees)


def _counted(docs: DataFrame) -> DataFrame:
    """``lang, gram, n``: 4-byte strings of the texts, each byte with its three before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 64):
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(as_list(batch, "lang"), as_list(batch, "text"), strict=True):
                raw = np.frombuffer(_PAD + text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
                by_lang.setdefault(lang, []).append(((raw[:-3] << 8 | raw[1:-2]) << 8 | raw[2:-1]) << 8 | raw[3:])
            for lang, found in by_lang.items():
                grams, n = np.unique(np.concatenate(found), return_counts=True)
                columns = [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    grams = docs.mapInArrow(run, "lang string, gram long, n long")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train_language_id(docs: DataFrame, rows: int = TRAINING_ROWS) -> ContextTrees:
    """Learn from ``docs`` (doc_id, text, lang), at most about ``rows`` documents of each language.

    The documents are chosen by a hash of their id and text. Rows with a null
    language or text teach nothing; repeated rows count each time. Only the counts
    of the chosen documents' 4-byte strings reach the driver.
    """
    docs = docs.where("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return ContextTrees()
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, rows / sizes[lang]))])
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003
    found = _counted(docs.where(chance < share[F.col("lang")])).toArrow()
    order = {lang: i for i, lang in enumerate(languages)}
    whose = np.array([order[x] for x in found.column("lang").to_pylist()], np.int64)
    return build_trees(languages, found.column("gram").to_numpy(), whose, found.column("n").to_numpy())


def identify_language(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """``doc_id, lang_pred, score`` for each row of ``docs``, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            found = shared.value.predict_all(as_list(batch, "text"))
            columns = [pa.array(as_list(batch, "doc_id"), pa.int64())]
            columns += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double")
