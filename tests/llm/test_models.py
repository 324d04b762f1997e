"""Language identification, quality and page text: held-out accuracy and odd rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mailweave.llm import html_text, language_id, mil_quality
from mailweave.llm.common import held_out


def test_language_of_held_out_rows(docs):
    model = language_id.fit(language_id.training_rows(docs))
    found = language_id.predict_language(docs, model).filter(held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("accepted").cast("int"))).first()
    assert right[0] > 0.97 and right[1] > 0.97


def test_kneser_ney_sums_to_one_over_known_next_characters():
    keys, sizes = language_id.grams(["the cat sat on the mat", "a hat"])
    assert sizes.sum() == len(keys)
    unique, counts = np.unique(keys, return_counts=True)
    model = language_id.KneserNey(unique, counts)
    context = unique[0] >> np.uint64(16)
    nexts = (context << np.uint64(16)) | np.arange(65536, dtype=np.uint64)
    assert model.probability(nexts).sum() == pytest.approx(1.0, abs=1e-6)


def test_a_model_in_tables_is_the_same(docs, odd, tiny_broadcast):
    """No gram is left out beyond the broadcast size, and nothing changes but the way."""
    training = language_id.training_rows(docs)
    small, large = language_id.fit(training), language_id.fit(training, most=0)
    assert isinstance(small, language_id.Model) and isinstance(large, language_id.Tables)
    assert large.langs == small.langs
    assert np.allclose(large.mean, small.mean, atol=1e-5) and np.allclose(large.limit, small.limit, rtol=1e-4)
    for df in (docs.filter("doc_id % 3 = 1").withColumn("_row", F.lit("kept")), odd):
        rows = lambda model: sorted(
            [(r.doc_id is None, r.doc_id or 0, r.text or "", r.lang_pred, round(r.score, 4), round(r.entropy or 0, 4), r.n_letters, r.accepted)
             for r in language_id.predict_language(df, model).collect()], key=repr
        )
        assert rows(large) == rows(small)
    assert language_id.predict_language(df.limit(0), large).count() == 0
    assert language_id.predict_language(df, large).columns == language_id.predict_language(df, small).columns


def test_probabilities_in_tables(spark):
    texts = {"a": ["abc abd", "aab", "zebra"], "b": ["xyz", "abc xyz " * 3]}
    rows = [(name, int(g), n) for name, own in texts.items() for g, n in zip(*map(list, np.unique(language_id.grams(own)[0].view(np.int64), return_counts=True)))]
    counted = spark.createDataFrame([(a, b, int(n)) for a, b, n in rows], "lang string, gram bigint, n bigint")
    model = language_id.Tables(counted, ["a", "b"])
    wanted = np.unique(language_id.grams(["abc", "zzz", "xyz abq", "öä"])[0])
    found = {r.gram: r.bits for r in model.bits(spark.createDataFrame([(int(g),) for g in wanted.view(np.int64)], "gram bigint")).collect()}
    for k, name in enumerate("ab"):
        keys = np.array([g for lang, g, _ in rows if lang == name], dtype=np.int64).view(np.uint64)
        one = language_id.KneserNey(keys, np.array([n for lang, _, n in rows if lang == name]))
        for g, p in zip(wanted.view(np.int64).tolist(), one.probability(wanted)):
            assert found[g][k] == pytest.approx(-np.log2(p), abs=1e-4)


def test_calibration_of_a_rare_language(spark, docs, monkeypatch):
    """Every language has its own sample, whatever the size of the others."""
    monkeypatch.setattr(language_id, "FEWEST", 20)
    known = docs.filter("lang IS NOT NULL AND length(text) > 200")
    en = known.filter("lang = 'en'").limit(100)
    de = known.filter("lang = 'de'").limit(30)
    training = en.unionByName(de).select("doc_id", "text", "lang")
    for k in range(4):
        training = training.unionByName(en.select((F.col("doc_id") + 10**7 * (k + 1)).alias("doc_id"), "text", "lang"))
    model = language_id.fit(training)
    sizes = []
    put = language_id.set_limits
    monkeypatch.setattr(language_id, "set_limits", lambda m, seen: (sizes.append(seen["lang"].value_counts().to_dict()), put(m, seen)))
    language_id.calibrate(model, training, "text", "lang", "doc_id", most=50)
    assert sizes[0][model.langs.index("de")] == 30 and 25 <= sizes[0][model.langs.index("en")] <= 80


def test_limits_come_from_all_texts(spark, monkeypatch):
    """More texts than any sample took; ranked in one window and by ranges."""
    monkeypatch.setattr(language_id, "FEWEST", 20)
    rng = np.random.default_rng(7)
    n = rng.integers(2, 900, 9000)
    seen = pd.DataFrame({"lang": [0] * 8000 + [2] * 990 + [1] * 10, "h": rng.normal(3, 0.4, 9000), "n": n})
    empty = pd.DataFrame({"lang": ["a", "b", "c", "d"], "gram": [1, 2, 3, 4], "n": 1})
    want = language_id.Model(empty)
    language_id.set_limits(want, seen)
    table = spark.createDataFrame(seen).withColumn("lang", F.col("lang").cast("int"))
    for rows in ("1000000", "0"):
        spark.conf.set("spark.mailweave.windowRows", rows)
        try:
            model = language_id.Model(empty)
            language_id.set_all_limits(model, table)
        finally:
            spark.conf.unset("spark.mailweave.windowRows")
        assert model.mean == pytest.approx(want.mean) and model.limit == pytest.approx(want.limit)


def test_every_training_text_is_measured(spark, docs, monkeypatch):
    sizes = []
    put = language_id.set_all_limits
    monkeypatch.setattr(language_id, "set_all_limits", lambda m, seen: (sizes.append(seen.count()), put(m, seen)))
    training = language_id.training_rows(docs)
    known = training.filter("lang IS NOT NULL AND text IS NOT NULL")
    many = known.crossJoin(spark.range(2).select("id")).select((F.col("doc_id") + F.col("id") * 10**7).alias("doc_id"), "text", "lang")
    language_id.fit(many)
    assert sizes == [sum(language_id.grams([r.text])[1][0] > 1 for r in many.collect())]


def test_limits_of_a_language_with_few_texts():
    rng = np.random.default_rng(5)
    model = language_id.Model(pd.DataFrame({"lang": ["a", "b", "c"], "gram": [1, 2, 3], "n": [1, 1, 1]}))
    seen = pd.DataFrame({"lang": [0] * 5000 + [1], "h": [*rng.normal(3, 0.2, 5000), 2.5], "n": 400})
    language_id.set_limits(model, seen)
    assert np.isfinite(model.limit).all()
    # One text or none: rejected by the spread of all texts, neither never nor at the least distance.
    for k in (1, 2):
        assert model.limit[k] == pytest.approx(model.limit[0], rel=0.05) and model.limit[k] > 10
        assert model.mean[k] == pytest.approx(3, abs=0.05)


def test_language_of_odd_rows(odd, none):
    model = language_id.fit(language_id.training_rows(odd))
    rows = language_id.predict_language(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred in ("en", "de") and 0 <= r.score <= 1
    empty = language_id.fit(language_id.training_rows(none))
    assert {r.lang_pred for r in language_id.predict_language(odd, empty).collect()} == {"und"}
    assert language_id.predict_language(none, model).count() == 0
    assert language_id.stage(none.sparkSession, odd, "").columns == odd.columns


def test_quality_of_held_out_rows(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = mil_quality.fit(docs, labels)
    rows = mil_quality.score_quality(docs, model).join(labels, "doc_id").filter(held_out(F.col("doc_id")))
    frame = rows.select("score", "quality").toPandas()
    good, bad = frame[frame["quality"] == 1]["score"], frame[frame["quality"] == 0]["score"]
    assert (good.to_numpy()[:, None] > bad.to_numpy()[None, :]).mean() > 0.97


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    model, sizes, y = mil_quality.Attention(5, 3), np.array([2, 1, 4]), np.array([1.0, 0.0, 1.0])
    x = rng.normal(size=(7, mil_quality.N_FEATURES))
    loss = lambda: -np.mean(y * np.log(model.forward(x, sizes)["score"]) + (1 - y) * np.log(1 - model.forward(x, sizes)["score"]))
    g = model.gradient(model.forward(x, sizes), y, 0.0)
    for name, at in (("e", (3, 2)), ("v", (1, 1)), ("u", (2, 0)), ("a", (1,)), ("o", (4,)), ("ob", (0,))):
        kept = model.w[name][at]
        model.w[name][at] = kept + 1e-5
        up = loss()
        model.w[name][at] = kept - 1e-5
        down = loss()
        model.w[name][at] = kept
        assert g[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(0, 1), (9, 0), (9, 1), (7, 0), (8, None), (None, 1)], "doc_id bigint, quality int")
    model = mil_quality.fit(odd, labels)
    rows = mil_quality.score_quality(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert mil_quality.score_quality(none, model).count() == 0
    untaught = mil_quality.fit(odd, labels.filter("doc_id < 0"))
    assert {r.score for r in mil_quality.score_quality(odd, untaught).collect()} == {0.5}


def test_quality_stage_keeps_what_is_predicted(docs, monkeypatch):
    model = mil_quality.Attention()
    monkeypatch.setattr(mil_quality, "fit", lambda *_: model)
    for model.share, kept in ((0.4, 0), (0.5, docs.count())):
        assert mil_quality.stage(docs.sparkSession, docs, "/root/testdata/sf0.01").count() == kept


def test_long_labelled_texts_are_learned_from(spark):
    junk, prose = "#### $$$$ 1234 !!!! " * 6000, "some plain words that follow each other " * 3000
    docs = spark.createDataFrame([(k, prose if k % 2 else junk) for k in range(12)], "doc_id bigint, text string")
    model = mil_quality.fit(docs, docs.selectExpr("doc_id", "int(doc_id % 2) AS quality"))
    assert model.share is None and model.scores([prose])[0] > 0.5 > model.scores([junk])[0]
    bag = mil_quality.drawn([str(k) for k in range(1000)], mil_quality.BAG)
    assert len(bag) == mil_quality.BAG and 0.3 < np.mean([int(p) >= 500 for p in bag]) < 0.7 and bag == sorted(bag, key=int)


PAGES = [
    (None, ""),
    ("", ""),
    ("<html><head><title>x</title></head><body><nav><a href='/'>Home</a></nav></body></html>", ""),
    ("<article><h1>A &amp; B</h1><p>one<p>two <b>b</b>old\n\t text</article><footer>&copy; x</footer>", "A & B\none\ntwo bold text"),
    ("<div class='cookie-banner'>We use cookies</div><main><p>Kept words here.</p><aside>no</aside><form>f <p>g</p></form></main>", "Kept words here."),
    ("<article><p>Text.</p><section class=comments><p>A reader says a lot of things here.</p></section><p>More.</p></article>", "Text.\nMore."),
    ("<article><p>a &lt;b&gt; &#233;&nbsp;c<script>if (a<b) {}</script><style>p{}</style></p></article><script>open", "a <b> é c"),
    ("<article><ul><li><a href=x>Related one</a></li><li><a href=y>Related two</a></li></ul><p>Only this text stays in.</p></article>", "Only this text stays in."),
]


def test_pages(spark):
    frame = pd.DataFrame({"page_id": range(len(PAGES)), "html": [p for p, _ in PAGES], "text": "old"})
    pages = spark.createDataFrame(frame, "page_id bigint, html string, text string")
    found = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    assert found == {k: want for k, (_, want) in enumerate(PAGES)}
    assert html_text.extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page, want", [
    ("<head class=header><meta charset=x><title>x</title><body><article><p>Some kept words here.</p></article>", "Some kept words here."),
    ("<head><script>'<p>'</script><link href=x><article><p>Some kept words here.</p></article>", "Some kept words here."),
    ("<article><p>One two <svg width='1'/>three four.</p><p>More words are here.</p></article>", "One two three four.\nMore words are here."),
    ("<article><p>One two three four.</p><svg><path d=x/>unseen</svg><p>More words are here.</p></article>", "One two three four.\nMore words are here."),
    ("<article><p>One two three four.</p><iframe class=ad><p>More words are here.</p></article>", "One two three four.\nMore words are here."),
    ("<article><p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> holds, <math/>so it is.</p></article>", "Here x=2 holds, so it is."),
    ("<article><p>One two three four.</p><textarea>to the end<p>More words are here.</p></article>", "One two three four."),
])
def test_unended_parts_of_a_page(page, want):
    assert html_text.main_text(page, html_text.grow(*html_text.labelled())) == want


def test_pages_of_the_given_table(spark):
    """The articles there are a heading and paragraphs, which the tree does not know."""
    import html as h
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in html_text.extract_text(pages).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?p>|</?h1>", article)
        parts = [" ".join(h.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in parts]
        assert r.text == "\n".join(p for p in parts if p)


LONG_PARAGRAPH = "some long text of words " * 10
KEPT = ["The title of it", LONG_PARAGRAPH.strip(), "More words are here and there."]
INNER = f"<h1>{KEPT[0]}</h1><p>{KEPT[1]}</p><p>{KEPT[2]}</p>"


@pytest.mark.parametrize("before, after", [
    ("<body class='post has-sidebar'>", "</body>"), ("<body class='sidebar'><article>", "</article>"),
    ("<div class='no-ads'>", "</div>"), ("<article class='post comments-open'>", "</article>"),
    ("<form id='aspnetForm'><article>", "</article></form>"), ("<main id='search'>", "</main>"),
    ("<div class='sidebar'><article>", "</article></div>"), ("<article><div class='entry-header'>", "</div></article>"),
    ("<div id='page-menu-open'>", "</div>"),
])
def test_names_do_not_empty_a_page(before, after):
    assert html_text.main_text(before + INNER + after, html_text.grow(*html_text.labelled())) == "\n".join(KEPT)


@pytest.mark.parametrize("page, want", [
    # A paragraph that is one link stays between texts, and goes beside other links.
    ("<article><p>Some words come first here.</p><p><a href=x>One link alone</a></p><p>Some words follow here.</p></article>",
     "Some words come first here.\nOne link alone\nSome words follow here."),
    ("<article><p>Some words come first here.</p><p><a href=x>One link alone</a></p><p><a href=y>Another link</a></p></article>",
     "Some words come first here."),
    # The same short line between long texts, and between links.
    (f"<div><p>{LONG_PARAGRAPH}</p><p>A short line.</p><p>{LONG_PARAGRAPH}</p></div>",
     "\n".join([LONG_PARAGRAPH.strip(), "A short line.", LONG_PARAGRAPH.strip()])),
    ("<div><p><a href=x>Menu</a></p><p>A short line.</p><p><a href=y>Menu</a></p></div>", ""),
    # Readers and others around an article.
    (f"<nav><a href=x>Home</a></nav><div class=notice>{LONG_PARAGRAPH}</div><article>{INNER}<div class='post-comments comments'><p>{LONG_PARAGRAPH}</p></div>"
     f"</article><section id=comments><article><p>{LONG_PARAGRAPH}</p></article></section><footer>{LONG_PARAGRAPH}</footer>", "\n".join(KEPT)),
    (f"<div class='siteHeader'>{LONG_PARAGRAPH}</div>{INNER}<div id='commentList'><p>{LONG_PARAGRAPH}</p></div>", "\n".join(KEPT)),
    ("<article><p class=\"a>b\" title='x>y' data-x=a>b>Kept are these words.</p></article>", "b>Kept are these words."),
    ("<article><p>Kept are these words.</p><p title=\"no end>More words are kept.</p></article>", "Kept are these words.\nMore words are kept."),
    ("<article><p>a < b and 3<4 hold.</p></article>", "a < b and 3<4 hold."),
])
def test_neighbours_and_places(page, want):
    assert html_text.main_text(page, html_text.grow(*html_text.labelled())) == want


def features_of(tree):
    return {tree[0]} | features_of(tree[2]) | features_of(tree[3]) if isinstance(tree, tuple) else set()


def test_the_tree_reads_the_neighbours_and_knows_its_table():
    x, y = html_text.labelled()
    tree = html_text.grow(x, y)
    assert features_of(tree) == set(range(len(html_text.FEATURES)))
    assert all(html_text.judge(tree, list(row)) == bool(label) for row, label in zip(x[::7], y[::7]))
    # No combination of values stands there with two labels.
    assert len(np.unique(x, axis=0)) == len(np.unique(np.column_stack([x, y]), axis=0))


@pytest.mark.parametrize("piece", [
    "<a", '<a"', "<", '<a x="', '<a x=">" ', "<!--", "<script>", "<svg>", "</script   ", "<style></style ", "<div></x>", "<p><x></p>", "&#",
    "<a x='>' y=\">", "<div><i></div><div>",
])
def test_broken_markup_takes_linear_time(piece):
    import time

    tree = html_text.grow(*html_text.labelled())
    start = time.process_time()
    html_text.main_text((piece * 200_000)[:200_000], tree)
    html_text.main_text("<div>" * 30_000 + (piece * 100_000)[:100_000] + "</div>" * 20_000, tree)
    assert time.process_time() - start < 4
