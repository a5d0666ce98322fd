"""Decontamination, quality, language ID and HTML extraction on small inputs."""

import re
from hashlib import sha256

import numpy as np
import pytest

from cueloom.llm.decontaminate import decontaminate, drop_contaminated
from cueloom.llm.html_extract import RegionWeights, best_region, extract_text, main_text, read_page, segment_scores, train_region_weights
from cueloom.llm.language_id import build_trees, identify_language, train_language_id
from cueloom.llm.quality import TERMS, fit_model, score_quality, terms, train_quality

DOCS = "doc_id long, text string"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _words(text):
    return WORDS.findall((text or "").translate(LOWER))


def _brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        words = _words(text)
        n = min(span, len(words))
        for i in range(len(words) - n + 1 if n and item is not None else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words, hit, met = _words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    met |= windows[tuple(words[i : i + n])]
        out.append((str(doc), len(words), len(hit), tuple(sorted(met))))
    return sorted(out)


PASSAGE = " ".join(f"Word{i}" for i in range(25))
ITEMS = [(1, PASSAGE), (2, "Short, ONE"), (2, "again " + PASSAGE), (3, None), (4, " -- "), (None, "lost item words"), (5, "ΑΣ ένα δύο τρία a b c d e f g")]
TEXTS = [
    (1, "before " + PASSAGE.lower() + " after"),
    (2, " ".join(PASSAGE.split()[3:13])),
    (3, " ".join(PASSAGE.split()[3:12])),
    (4, "short\none SHORT one-two; short one"),
    (5, None),
    (6, ""),
    (6, "short one"),
    (7, "ΑΣ'ένα δύο τρία a b c d e f g"),
    (8, "ας ένα δύο τρία a b c d e f g"),
    (None, "x short one"),
    (None, None),
    (9, "word1 " * 60),
    (9, "word1 " * 60),
    (10, PASSAGE + " gap " + PASSAGE),
]


def test_decontaminate_equals_brute_force(spark):
    docs = spark.createDataFrame([(*t, 7) for t in TEXTS], DOCS + ", n_words int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontaminate(docs, items).collect()
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in rows)
    assert found == _brute(TEXTS, ITEMS)
    assert all(r["n_hit"] == sum(s["end"] - s["start"] for s in r["spans"]) for r in rows)
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == sum(hit == 0 for _, _, hit, _ in found)


def test_decontaminate_very_long_texts(spark):
    text = " ".join(f"w{i % 977}" for i in range(200_000)) + " " + PASSAGE + " end" * 50_000
    rows = [(1, text), (1, text), (2, text.replace("Word12 ", ""))]
    found = decontaminate(spark.createDataFrame(rows, DOCS), spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"]) for r in found.collect()) == [(1, 250_025, 25)] * 2 + [(2, 250_024, 24)]


def test_decontaminate_of_nothing(spark):
    docs = spark.createDataFrame(TEXTS, DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate(docs, none).collect()} == {0}
    assert decontaminate(docs.limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_decontaminate_query_columns(spark, sf_dir):
    from cueloom.llm.queries import op4_decontaminate

    rows = op4_decontaminate(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    expected = _brute(docs, items)
    digest = lambda ids: sha256(",".join(ids).encode()).hexdigest()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items_sha256"]) for r in rows) == [
        (d, w, h, digest(i)) for d, w, h, i in expected
    ]


def test_quality_learns_repetition(spark):
    good = [(i, f"This is sentence number {i}. It tells of things that are {i % 7} times new.") for i in range(60)]
    bad = [(100 + i, "spam " * (20 + i)) for i in range(40)]
    docs = spark.createDataFrame([(*r, 3.0, "x") for r in good + bad], DOCS + ", score double, predicted string")
    labels = spark.createDataFrame(
        [(i, 1) for i in range(0, 60, 2)] + [(100 + i, 0) for i in range(0, 40, 2)] + [(1, 0), (1, 1), (None, 1), (3, None), (0, 1)],
        "doc_id long, label int",
    )
    model = train_quality(docs, labels)
    assert len(model.labels) == 50
    extra = spark.createDataFrame([(None, None, 0.0, ""), (900, "", 0.0, ""), (901, " ", 0.0, "")], docs.schema)
    rows = score_quality(docs.unionByName(extra), model).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["predicted"] == 1 for i, _ in good) and all(by_id[i]["predicted"] == 0 for i, _ in bad)
    assert all(0 <= r["score"] <= 1 for r in rows) and by_id[None]["score"] == by_id[900]["score"]
    untaught = train_quality(docs, labels.limit(0))
    assert {r["score"] for r in score_quality(docs, untaught).collect()} == {0.5}
    assert score_quality(docs.limit(0), model).count() == 0


def _votes(model, text, neighbours=25):
    """The vote of all labelled vectors that are no further than the last neighbour, one cosine at a time."""
    own = terms(text) @ model.projection
    length = float(np.sqrt((own * own).sum()))
    cosines = [round(float(own @ v) / (length or 1.0), 6) for v in model.vectors]
    least = sorted(cosines)[max(0, len(cosines) - neighbours)]
    votes = [(max(c, 0.0) ** 4, label) for c, label in zip(cosines, model.labels, strict=True) if c >= least]
    total = sum(v for v, _ in votes)
    return sum(v * label for v, label in votes) / total if total else model.prior


def test_quality_equals_votes_of_all_labelled_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id", "quality as label")
    model = train_quality(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = {r["doc_id"]: r["label"] for r in labels.collect() if r["label"] is not None and r["doc_id"] in texts}
    rows = np.array([terms((texts[i] or "").encode()).astype(np.float16).astype(np.float64) for i in sorted(known)])
    scaled = rows * (np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 0.1)
    _, values, right = np.linalg.svd(scaled, full_matrices=False)
    latent = rows @ ((np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 0.1)[:, None] * right[:48].T)
    latent /= np.linalg.norm(latent, axis=1, keepdims=True)
    assert values[47] > 1e-3
    np.testing.assert_allclose(model.vectors @ model.vectors.T, latent @ latent.T, atol=2e-3)
    long_ = "Words of a very long text. " * 100_000
    asked = docs.unionByName(spark.createDataFrame([(-1, long_), (-2, ""), (-3, None)], docs.schema))
    texts |= {-1: long_, -2: "", -3: None}
    for r in score_quality(asked, model).collect():
        assert r["score"] == pytest.approx(_votes(model, (texts[r["doc_id"]] or "").encode()), abs=2e-3)


def test_quality_ties_vote_together():
    rows = np.array([terms(b"same text here")] * 4 + [terms(b"OTHER!! THING!!")] * 2)
    model = fit_model(rows, np.array([1, 1, 0, 0, 0, 0], np.float32))
    assert model.score(rows[:1], neighbours=1)[0] == pytest.approx(0.5)
    assert rows.shape[1] == TERMS


def test_language_probabilities_sum_to_one():
    grams = np.array([int.from_bytes(b"\n\n\na"), int.from_bytes(b"abab"), int.from_bytes(b"baba")])
    trees = build_trees(["x", "y"], grams, np.array([0, 0, 1]), np.array([1, 30, 40]), least=1)
    known = trees.bits.shape[1] - 1
    for language in range(2):
        p = np.exp2(-trees.bits[:, :, language])
        np.testing.assert_allclose(p[:, :known].sum(axis=1) + (256 - known) * p[:, known], 1, rtol=1e-4)


def test_language_of_texts(spark):
    spoken = {"en": "the cat sat on the mat and then it was gone ", "de": "die Katze saß auf der Matte und dann ging sie "}
    rows = [(i, text * 5, lang) for i, (lang, text) in enumerate(list(spoken.items()) * 6)]
    rows += [(90, None, "en"), (91, "no label", None)]
    docs = spark.createDataFrame(rows, DOCS + ", lang string")
    trees = train_language_id(docs)
    asked = [(1, "the mat"), (2, "der Katze"), (3, None), (4, ""), (5, "12 !"), (None, "then it was")]
    found = {r["doc_id"]: r for r in identify_language(spark.createDataFrame(asked, DOCS), trees).collect()}
    assert [found[i]["lang_pred"] for i in (1, 2, 3, 4, 5, None)] == ["en", "de", "und", "und", "und", "en"]
    assert found[3]["score"] == 0 and 0.5 < found[1]["score"] <= 1
    untaught = train_language_id(docs.limit(0))
    assert identify_language(docs, untaught).first()["lang_pred"] == "und"


def _ppm_bits(texts, asked, kept):
    """Code length of ``asked`` by counting contexts of 0 to 3 bytes of ``texts``; of three bytes only ``kept`` ones count."""
    counts = {}
    for text in texts:
        raw = b"\n\n\n" + text
        for i in range(3, len(raw)):
            for order in range(4):
                seen = counts.setdefault(raw[i - order : i], {})
                seen[raw[i]] = seen.get(raw[i], 0) + 1

    def chance(byte, context):
        lower = (lambda b: chance(b, context[1:])) if context else (lambda b: 1 / 256)
        seen = counts.get(context, {})
        if not seen or (len(context) == 3 and context not in kept):
            return lower(byte)
        total = sum(seen.values()) + len(seen)
        if byte in seen:
            return seen[byte] / total
        return len(seen) / total * lower(byte) / max(1 - sum(lower(b) for b in seen), 1e-12)

    raw = b"\n\n\n" + asked
    return sum(-np.log2(chance(raw[i], raw[i - 3 : i])) for i in range(3, len(raw)))


def test_code_lengths_equal_counted_contexts(spark):
    spoken = {"en": ["the cat sat on the mat, then the cat ate", "that is the hat"] * 3, "de": ["die Katze saß da, die Matte auch", "das ist der Hut"] * 3}
    rows = [(i, t, lang) for lang, texts in spoken.items() for i, t in enumerate(texts)]
    trees = train_language_id(spark.createDataFrame(rows, DOCS + ", lang string"))
    together = {}
    for _, text, _ in rows:
        raw = b"\n\n\n" + text.encode()
        for i in range(3, len(raw)):
            together[raw[i - 3 : i]] = together.get(raw[i - 3 : i], 0) + 1
    kept = {c for c, n in together.items() if n >= 12}
    assert 0 < len(kept) < len(together)
    for asked in ("the cat", "die Katze", "xyz the mat on der Hut", "\u4e16!", "a"):
        expected = [_ppm_bits([t.encode() for t in spoken[lang]], asked.encode(), kept) for lang in trees.languages]
        np.testing.assert_allclose(trees.code_lengths(asked.encode()), expected, rtol=1e-4)


def test_language_ties_long_texts_and_other_columns(spark):
    both = spark.createDataFrame([(1, "same words", "bb"), (1, "same words", "aa")], DOCS + ", lang string")
    trees = train_language_id(both)
    assert trees.predict("same words") == ("aa", 0.5)
    long_ = "words same " * 200_000
    np.testing.assert_allclose(trees.code_lengths(long_.encode()), 2 * trees.code_lengths((long_[: len(long_) // 2]).encode()), rtol=1e-3)
    clashing = spark.createDataFrame([(1, "same", "x", 3.0, "y"), (1, "same", "x", 3.0, "y")], DOCS + ", lang string, score double, lang_pred string")
    found = identify_language(clashing, trees)
    assert found.columns == ["doc_id", "lang_pred", "score"]
    assert [tuple(r) for r in found.collect()] == [(1, "aa", 0.5)] * 2


def test_held_out_language_accuracy(spark, sf_dir):
    from cueloom.llm.queries import op3_language_id

    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in op3_language_id(spark, sf_dir).collect() if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a></ul></nav>"
    "<!-- <p>no</p> --><div class=\"ad\">Buy <b>now</b></div>{open}<h1>Big &amp; small</h1><p><b>First&nbsp; one.<br>More"
    "<p>Sec<i>on</i>d &#233;&lt;tag&gt;<script>var t='</p>';</script><div class='comments'><p>I agree a lot with all of it</p></div>"
    "<p>Last</p>{close}<form><input>Send</form><footer><p>&copy; all rights</p></footer></body>"
)
TEXT = "Big & small\nFirst one. More\nSecond é<tag>\nLast"


def test_html_with_and_without_landmark():
    weights = RegionWeights()
    assert main_text(PAGE.replace("{open}", "<article>").replace("{close}", "</article>"), weights) == TEXT
    assert main_text(PAGE.replace("{open}", "<div>").replace("{close}", "</div>"), weights) == TEXT
    assert main_text("<article>a <span title='x>y'>b</span> c", weights) == "a b c"
    for nothing in (None, "", "<nav>x</nav>", "<p></p>", "<!-- "):
        assert main_text(nothing, weights) == ""


def test_html_of_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    weights = train_region_weights(pages)
    extra = spark.createDataFrame([(None, None, None), (-1, "u", ""), (-1, "u", "")], pages.schema)
    rows = extract_text(pages.unionByName(extra), weights).collect()
    assert len(rows) == pages.count() + 3
    texts = {r["page_id"]: r["text"] for r in rows}
    assert texts[None] == texts[-1] == ""
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1]
        words = re.sub(r"<[^>]*>", " ", inside).replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">").replace("&quot;", '"').split()
        assert texts[r["page_id"]].split() == [w for w in words]
    assert train_region_weights(pages.limit(0)) == RegionWeights()
    assert extract_text(pages.limit(0), weights).count() == 0
    clashing = pages.limit(2).selectExpr("*", "url as text", "0 as n_chars")
    assert extract_text(clashing, weights).columns == ["page_id", "url", "text", "n_chars"]


BODY = "<h1>Head line</h1><p>" + "One two three four five. " * 3 + "</p><p>" + "Six seven eight. " * 4 + "</p>"
BODY_TEXT = "Head line\n" + " ".join(["One two three four five."] * 3) + "\n" + " ".join(["Six seven eight."] * 4)
NAMED = [
    '<article class="post popular">{}</article>',
    '<article class="post comments-open">{}</article>',
    '<article id="menu-planning-guide">{}</article>',
    '<article class="entry notice">{}</article>',
    '<main><article class="item trending">{}</article></main>',
    '<article><div class="share-price related">{}</div></article>',
    '<section class="hidden-gems widget-2">{}</section>',
    '<form><nav><a href="/">Menu</a></nav><div class="row">{}</div></form>',
    '<nav><a href="/">unclosed menu</a><article>{}</article>',
    '<div class="related"><article><p>A teaser of some words</p></article></div><article class="post">{}</article>',
]


def test_names_do_not_empty_an_article(spark, sf_dir):
    learned = train_region_weights(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    for weights in (learned, RegionWeights()):
        for page in NAMED:
            assert main_text(f"<html><body>{page.format(BODY)}</body></html>", weights) == BODY_TEXT, page
        inside = BODY + '<p class="promo-code-howto">How to use a code</p><blockquote class="reply">Said so</blockquote><aside>Not this</aside>'
        assert main_text(f"<article>{inside}</article>", weights) == BODY_TEXT + "\nHow to use a code\nSaid so"
    comments = '<ul class="c-list"><li><b>Joe</b><p>I agree a lot with all of it</p></li><li><b>Al</b><p>Me too, I say</p></li></ul>'
    assert main_text(f"<html><body>{BODY}{comments}</body></html>", learned) == BODY_TEXT


SIDE_MATTER = [
    '<div class="comments clearfix"><p>I agree a lot with it</p></div>',
    '<section id="post-comments"><h2>Comments</h2><p>I agree a lot with it</p></section>',
    '<ol class="comment-list dark"><li class="comment-item"><p class="comment-text">I agree</p></li></ol>',
    '<div class="ad ad-leaderboard col-md-4">Buy now</div>',
    '<div role="dialog"><p>We use cookies here</p></div>',
    '<p class="cookie-notice">We use cookies here</p>',
    '<form><label>Mail</label><input><button>Send</button></form>',
    '<div hidden><p>Not shown at all</p></div>',
    '<article class="comment"><p>I agree a lot with it</p></article>',
    '<aside><p>See this as well</p></aside>',
]


def test_side_matter_inside_and_beside_an_article(spark, sf_dir):
    learned = train_region_weights(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    for weights in (learned, RegionWeights()):
        for side in SIDE_MATTER:
            for page in (f"<article>{BODY}{side}</article>", f"<main><article>{BODY}</article>{side}</main>", f"<div>{BODY}{side}</div>"):
                assert main_text(f"<html><body>{page}</body></html>", weights) == BODY_TEXT, page
        kept = '<figure><figcaption class="caption-text">A caption</figcaption></figure><table><tr><td>A cell</td></tr></table>'
        assert main_text(f"<article><header>{BODY}</header>{kept}</article>", weights) == BODY_TEXT + "\nA caption\nA cell"


def test_pages_without_marks_lose_menus_and_notices(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    weights = train_region_weights(pages)
    assert weights.words[(False, False, "a<li")] < -0.9 < 0.9 < weights.words[(False, False, "p<body")]
    named = RegionWeights()  # what the list alone lets through
    differing = 0
    for r in pages.collect():
        bare = re.sub(r"</?article[^>]*>", "", re.sub(r' (?:class|id|role)="[^"]*"', "", r["html"]))
        bare = re.sub(r"<(/?)(?:nav|footer|aside|header)(?=[\s>])", r"<\1div", bare)
        assert main_text(bare, weights) == main_text(r["html"], weights)
        differing += main_text(bare, named) != main_text(bare, weights)
    assert differing == pages.count()


def test_region_equals_all_ranges():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(0, 12))
        scores = list(zip(rng.choice([0.0, 0.5, 2.0], n).tolist(), rng.integers(-3, 4, n).astype(float).tolist(), strict=True))
        value = lambda i, j: sum(s for _, s in scores[i:j]) - sum(c for c, _ in scores[i + 1 : j])  # noqa: E731, B023
        every = [value(i, j) for i in range(n) for j in range(i + 1, n + 1)]
        first, last = best_region(scores)
        assert (value(first, last) if first < last else 0.0) == max([0.0, *every])


def test_html_long_pages():
    weights = RegionWeights()
    assert main_text("<b>x " * 50_000, weights) == " ".join(["x"] * 50_000)
    assert main_text("<div class='c'><p>y" * 20_000, weights).count("y") == 20_000
    assert len(main_text("<article><p>" + "word " * 300_000, weights)) == 1_499_999
    page = read_page("<p>one two<nav>three</nav>", weights)
    assert [s for _, s in segment_scores(page, weights)] == [2.0, 0.0]
