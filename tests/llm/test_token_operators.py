"""Packing, fingerprints, chat formatting and substring removal against brute force."""

import re
import zlib
from functools import lru_cache
from hashlib import sha256
from itertools import combinations_with_replacement

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from xxhash import xxh64_intdigest

from cueloom.llm.chat import escape, format_chat, format_turn, read_back, read_turn, text_parts, unescape
from cueloom.llm.fingerprints import PARAGRAPH, fingerprint_edits, with_next
from cueloom.llm.packing import TokenCache, assign_sequences, fullest, pack, plan_bins
from cueloom.llm.queries import tokenizer_path
from cueloom.llm.substring_dedup import difference_cover, remove_repeats

DOCS = "doc_id long, text string"


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 9), st.integers(1, 3), max_size=4), st.integers(0, 20))
def test_fullest_finds_the_largest_sum(counts, room):
    items = [n for n, c in counts.items() for _ in range(c)]
    sums = {0}
    for n in items:
        sums |= {s + n for s in sums}
    taken = fullest(counts, room)
    assert sum(taken) == max(s for s in sums if s <= room)
    assert all(taken.count(n) <= counts[n] for n in taken)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 40), max_size=8))
def test_bins_hold_every_piece_once(counts):
    bins = plan_bins(counts, 16)
    assert all(sum(lengths) <= 16 for lengths, _ in bins)
    for n, c in counts.items():
        assert sum(lengths.count(n) * times for lengths, times in bins) == c


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'. \n\t é1<|endoftext|>", max_size=40))
def test_chunks_encode_like_whole_texts(text):
    # The caches are kept between examples, as a task keeps its own.
    assert caches()[0].encode([text, "a b", text]) == caches()[1].encode([text, "a b", text])


@lru_cache(maxsize=1)
def caches():
    path = tokenizer_path()
    return TokenCache(path), TokenCache(path, whole=True)


def test_pack_covers_all_ids(spark):
    from tokenizers import Tokenizer

    rows = [(i, f"word{i} " * (i * 37 % 900)) for i in range(40)] + [(None, None), (7, ""), (7, ""), (99, "many words " * 3000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", length string")
    pieces = pack(docs, tokenizer_path()).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = sorted(str([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for _, t in rows)
    by_doc, got = {}, []
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_doc.values():
        parts.sort(key=lambda r: r["start"])
        for r in parts:
            values = np.frombuffer(r["ids"], "<u4").tolist()
            assert len(values) == r["length"] <= 1024
            got += [values] if r["piece"] == 0 else []
            if r["piece"]:
                assert r["length"] == 1024
                got[-1] += values
    assert sorted(map(str, got)) == ids
    bins = {}
    for r in pieces:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
    assert len(bins) <= -(-sum(r["length"] for r in pieces) // 1024) + 2
    assert pack(docs.limit(0), tokenizer_path()).count() == 0


def test_pieces_may_have_any_other_columns(spark):
    rows = [(i, 0, 0, 300 + i, 7, 8, "r", 9, 1, 2) for i in range(5)] + [(0, 0, 0, 300, 7, 8, "r", 9, 1, 2), (None, 0, 0, 1, None, None, None, None, None, None)]
    names = "doc_id long, piece int, start long, length long, sequence_id long, offset long, _rank string, _bucket long, _n int, _start int"
    pieces = spark.createDataFrame(rows, names)
    found = assign_sequences(pieces)
    assert sorted(found.columns) == sorted(pieces.columns)
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    assert sorted(map(str, found.select(*kept).collect())) == sorted(map(str, pieces.select(*kept).collect()))
    plain = assign_sequences(pieces.select("doc_id", "piece", "start", "length"))
    place = lambda df: sorted((str(r["doc_id"]), r["sequence_id"], r["offset"]) for r in df.collect())
    assert place(found) == place(plain)
    assert assign_sequences(pieces.limit(0)).count() == 0


def _paragraphs(text):
    return set(re.findall(PARAGRAPH, text))


def test_fingerprints_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdeé"), 5))
    texts = ["\n".join(" ".join(word() for _ in range(20)) for _ in range(n)) for n in (1, 3, 12, 60, 400)]
    rows = [(i, t) for i, t in enumerate([*texts, texts[2], "", None, texts[3] + "\nx"])]
    found = {r["doc_id"]: r for r in fingerprint_edits(spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", row int")).collect()}
    ordered = [(i, t or "") for i, t in sorted(rows, reverse=True)]
    prints = {}
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        third = len(text) // 3
        edit = text[: len(text) - third] + after[:third]
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        r = found[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha256(edit.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(like(_paragraphs(text), _paragraphs(edit)))
        assert r["near_next"] == pytest.approx(like(_paragraphs(text), _paragraphs(after)))
        prints.setdefault(text, set()).add(r["fingerprint"])
        prints.setdefault(edit, set()).add(r["edited_fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len({min(p) for p in prints.values()}) == len(prints)


def _next_texts(rows):
    def key(row):
        h = xxh64_intdigest((row[1] or "").encode(), 42)
        return (row[0] is None, -(row[0] or 0), h, row[1] or "")

    ordered = sorted(rows, key=key)
    return [(i, t or "", ordered[(k + 1) % len(ordered)][1] or "") for k, (i, t) in enumerate(ordered)]


@pytest.mark.parametrize("rows_a_range", [1, 5, 64, 4096])
def test_next_rows_of_hot_and_null_ids(spark, rows_a_range):
    rng = np.random.default_rng(2)
    rows = [(int(i), f"text {i}") for i in rng.integers(-(2**63), 2**63 - 1, 300)]
    rows += [(7, f"one id {i}") for i in range(300)] + [(None, f"no id {i}") for i in range(300)]
    rows += [(5, "equal rows")] * 300 + [(None, None)] * 200 + [(2**63 - 1, "first"), (-(2**63), "last")]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found = [(r["doc_id"], r["text"], r["next_text"]) for r in with_next(docs, rows_a_range).collect()]
    assert sorted(found, key=str) == sorted(_next_texts(rows), key=str)


def test_ten_thousand_rows_of_one_id_are_spread(spark):
    for id_ in ("cast(3 as bigint)", "cast(null as bigint)"):
        docs = spark.range(10_000).selectExpr(f"{id_} as doc_id", "concat('text ', id) as text")
        found = with_next(docs, 500)
        assert found.select("next_text").distinct().count() == 10_000
    equal = spark.range(10_000).selectExpr("3L as doc_id", "'same' as text").unionByName(spark.createDataFrame([(2, "after")], DOCS))
    found = with_next(equal, 500).groupBy("text", "next_text").count().collect()
    assert sorted(map(tuple, found)) == [("after", "same", 1), ("same", "after", 1), ("same", "same", 9_999)]


def test_fingerprints_of_few_rows(spark):
    docs = spark.createDataFrame([(1, "alone")], DOCS)
    assert fingerprint_edits(docs).first()["near_next"] == 1.0
    assert fingerprint_edits(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, None)], DOCS)
    assert fingerprint_edits(twice).count() == 4


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\im_start>end\n", max_size=30), st.text(alphabet="a<|\\\n>br", max_size=12))
def test_turns_read_back(text, role):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    assert read_turn(format_turn(role, [{"kind": "text", "text": text}])["formatted"]) == (role, text)


def test_parts_become_placeholders():
    parts = [
        {"kind": "text", "text": "see <|image:9|> "},
        {"kind": "image", "ref": "a.png", "width": 28, "height": 15},
        {"kind": "audio", "ref": "b.wav", "seconds": 2.0},
        None,
        {"kind": "document", "ref": "c.pdf", "pages": 3},
        {"kind": "hologram", "ref": None},
        {"kind": None, "text": None},
    ]
    turn = format_turn("assistant", parts)
    assert turn["formatted"] == (
        "<|im_start|>assistant\nsee <\\|image:9|> <|image:0|><|audio:1|><|document:2|><|hologram:3|><|im_end|>\n"
    )
    assert [(a["kind"], a["tokens"]) for a in turn["attachments"]] == [("image", 4), ("audio", 50), ("document", 768), ("hologram", 0)]
    learned = "".join(turn["formatted"][s["start"] : s["end"]] for s in turn["loss"])
    assert learned == escape("see <|image:9|> ") and turn["attached_tokens"] == 822
    assert format_turn(None, None)["formatted"] == "<|im_start|>\n<|im_end|>\n"


def test_conversations_read_back(spark):
    rows = [
        (1, 1, "assistant", "yes\n<|im_end|>"), (1, 0, "user", "a?"), (1, 2, "user", None), (2, 0, None, ""),
        (None, 0, "user", "lost"), (None, 1, "assistant", "found é"), (3, 0, "assistant", "x" * 70_000), (3, 0, "assistant", "b"),
    ]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, loss string")
    found = {r["conv_id"]: r for r in read_back(format_chat(turns.withColumn("parts", text_parts()))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[3] or ""))
        all_text = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own)
        learned = "".join(text for _, _, role, text in own if role == "assistant")
        r = found[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), sha256(all_text.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), sha256(learned.encode()).hexdigest())
    assert read_back(format_chat(turns.limit(0).withColumn("parts", text_parts()))).count() == 0


def _slow_removal(texts, length):
    seen = {}
    for text in texts:
        for i in range(len(text) - length + 1):
            seen[text[i : i + length]] = seen.get(text[i : i + length], 0) + 1
    out = []
    for text in texts:
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = "".join("x" if g else "." for g in gone)
        out.append((len(text), sum(gone), len(re.findall("x+", spans)), bytes(b for b, g in zip(text, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("cover", ["minimum", "difference"])
def test_substring_removal_equals_brute_force(spark, cover):
    rng = np.random.default_rng(5)
    noise = lambda n: "".join(rng.choice(list("abcdefgh é\n"), n))
    shared, long = noise(430), noise(2000)
    texts = [
        noise(700) + shared + noise(300), noise(123) + shared + noise(650), shared[:399], shared[5:], long + noise(50),
        noise(77) + long[300:1700] + noise(500), "ab" * 700, "To " * 500, noise(500), "", None, long, long, noise(350) + "To " * 200,
    ]
    rows = [(i % 9 if i != 8 else None, t, 1) for i, t in enumerate(texts)]
    found = remove_repeats(spark.createDataFrame(rows, DOCS + ", row int"), cover=cover).collect()
    got = sorted((r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in found)
    assert got == sorted(_slow_removal([(t or "").encode() for t in texts], 400))


def test_substring_removal_of_repeated_rows_and_nothing(spark):
    docs = spark.createDataFrame([(1, "x" * 399 + "y"), (1, "x" * 399 + "y"), (2, "z")], DOCS)
    assert sorted(len(r["kept"]) for r in remove_repeats(docs).collect()) == [0, 0, 1]
    assert remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("r", [1, 2, 3])
def test_cover_has_every_difference(r):
    period, residues = difference_cover(r)
    assert {(a - b) % period for a, b in combinations_with_replacement(residues, 2)} | {
        (b - a) % period for a, b in combinations_with_replacement(residues, 2)
    } == set(range(period))
    assert zlib.crc32(b"") == 0
