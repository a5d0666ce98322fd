"""The pipeline's stages, one after the other, on the small tables."""

import struct
from itertools import combinations
from zlib import crc32

import numpy as np
from conftest import SF_DIR
from test_near_copies import _roots, _slow_dedup, _slow_print
from test_text_operators import _brute, _votes
from tokenizers import Tokenizer

import corpus_pipeline
from cueloom.llm.quality import train_quality
from cueloom.llm.queries import id_remainder, tokenizer_path


def test_stages_keep_the_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_dedup", "benchmark_decontamination", "best_fit_packing",
    ]
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0.5 * before < docs.count() <= before
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert pieces.where("piece = 0").count() == docs.count()


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _sentence(rng, words):
    return " ".join("".join(rng.choice(list("abcdefghilmnorstu"), int(n))) for n in rng.integers(2, 9, words)).capitalize() + "."


def _tables(spark, folder):
    """Documents that each stage has something to do with, labels and a benchmark."""
    rng = np.random.default_rng(5)
    texts = ["\n".join(_sentence(rng, 30) for _ in range(3)) for _ in range(40)]
    passage = _sentence(rng, 14)
    texts[3] += "\n" + texts[4].split("\n")[0]  # a line that repeats
    texts[5] += "\n" + texts[6].split("\n")[1] + " more"  # and one nearly so
    texts += [texts[i].replace("\n", " ") for i in (7, 8)] + [texts[9].replace("\n", " ").upper()]  # near copies
    texts += [texts[10] + " " + passage, f"Some words before {passage.lower()} and after it all."]  # of the benchmark
    texts += ["buy now " * (40 + i) for i in range(20)]  # of no quality
    texts += [" ".join(_sentence(rng, 40) for _ in range(40)), "", None, " \n "]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)] + [(None, texts[11], "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    spam = {i for i, t in enumerate(texts) if t and t.startswith("buy now")}
    labels = spark.createDataFrame([(i, int(i not in spam), 0) for i in range(0, 65, 2)], "doc_id long, quality int, toxic int")
    items = [(1, passage), (2, None), (3, "words that occur in no document at all of these")]
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, labels, [r[:2] for r in rows], items


def _plain(spark, docs, labels, rows, items):
    """``(stage, kept rows)`` by plain Python; the classifier's model is the only part shared with the stage."""
    known = labels.where(id_remainder("doc_id", 3) != 1).selectExpr("doc_id", "quality as label")
    model = train_quality(docs, known)
    rows = [r for r in rows if _votes(model, (r[1] or "").encode()) >= 0.5]
    yield rows
    ids, texts = {str(r[0]): r[0] for r in rows}, {str(r[0]): r[1] for r in rows}
    rows = [(ids[i], None if texts[i] is None else t) for i, t, *_ in _slow_dedup(rows)]
    yield rows
    prints = [_slow_print(t) for _, t in rows]
    root = _roots(range(len(rows)), [(a, b) for a, b in combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 4])
    best = {}
    for i, (doc_id, text) in enumerate(rows):
        own = (doc_id is None, doc_id or 0, text is not None, text or "")
        best[root[i]] = min(best.get(root[i], own), own)
    rows = [(None if none else d, t if some else None) for none, d, some, t in best.values()]
    yield rows
    hit = {i for i, _, n, _ in _brute(rows, items) if n}
    yield [r for r in rows if str(r[0]) not in hit]


def test_run_equals_plain_python(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    tables = _tables(spark, folder)
    stages = list(_plain(spark, *tables))
    sizes = [len(tables[2]), *map(len, stages)]
    assert all(a > b for a, b in zip(sizes, sizes[1:], strict=False) if (a, b) != (sizes[1], sizes[2]))
    assert stages[0] != stages[1]
    docs = tables[0]
    order = lambda found: sorted(found, key=str)
    for (_, stage), expected in zip(corpus_pipeline.STAGES, stages, strict=False):
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "test-chain")
        assert order((r["doc_id"], r["text"]) for r in docs.collect()) == order(expected)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = {}
    monkeypatch.setattr("cueloom.runtime.scratch_dir", lambda spark: f"{folder}/scratch")
    found = corpus_pipeline.run(spark, folder).collect()
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "scratch/cueloom").iterdir()}
    stage_tables = {name for name, _ in corpus_pipeline.STAGES[:-1]}
    assert stage_tables <= left and not left & {"lines", "members", "nodes", "fingerprints", "distinct-lines"}
    for r in found:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == {doc_id for doc_id, _ in stages[-1]}
    places = {}
    for doc_id, text in stages[-1]:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // 1024)))
        at = 0
        for r in own:
            part = ids[at : at + r["length"]]
            assert (r["start"], r["ids_crc32"]) == (at, crc32(struct.pack(f"<{len(part)}I", *part)))
            at += r["length"]
            places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert at == len(ids)
    for found in places.values():
        ends = np.cumsum([0, *(n for _, n in sorted(found))]).tolist()
        assert [at for at, _ in sorted(found)] == ends[:-1] and ends[-1] <= 1024


def test_run_of_empty_tables(spark, tmp_path):
    for name, schema in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == 0 and "sequence_id" in found.columns
