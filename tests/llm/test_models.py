"""Quality, toxicity, markup and secrets: held-out accuracy and hand-made cases."""

import html
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import markup, quality, secrets, toxicity
from ratingloom.llm.common import first_by_hash, held_out, labelled_sample

SCHEMA = "doc_id long, text string, score int, lang string"
ODD = [
    (1, None, 1, "en"), (2, "", 2, None), (None, "Some plain words here.", 3, "en"),
    (4, "word " * 40_000, 4, "de"), (4, "word " * 40_000, 4, "de"), (5, "\n\n \n", 5, "x"),
]


@pytest.fixture(scope="module")
def tables(spark):
    base = "/root/testdata/sf0.1"
    return {t: spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels", "pages")}


def test_held_out_is_crc_of_the_id_as_text(spark):
    rows = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", held_out().alias("h"))
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows.collect())


def test_copies_use_up_one_place_of_a_sample(spark):
    texts = spark.range(3000).select(F.concat(F.lit("t"), F.col("id")).alias("text"))
    hot = texts.orderBy(F.xxhash64("text")).first()["text"]
    rows = texts.unionByName(spark.range(2000).select(F.lit(hot).alias("text")))
    expected = [r["text"] for r in texts.orderBy(F.xxhash64("text")).limit(1000).collect()]
    found = [r["text"] for r in first_by_hash(rows, "text", 1000).collect()]
    assert hot in found and sorted(found) == sorted(expected)


@pytest.mark.parametrize("balanced", [False, True])
def test_labelled_sample_takes_an_id_once(spark, balanced):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(i, f"t{i} {k}") for i in ids for k in range(50 if i < 9 else 1)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids for _ in range(50 if i < 9 else 1)], "doc_id long, quality int")
    sample = labelled_sample(docs, labels, "quality", len(ids), balanced)
    found = [(int(r["text"].split()[0][1:]), r["y"]) for r in sample.collect()]
    assert sorted(found) == [(i, i % 2) for i in ids]
    few = labelled_sample(docs, labels, "quality", 5, balanced).collect()
    assert len(few) == (10 if balanced else 5)


def _accuracy(scored, labels, label):
    both = scored.filter("held_out").join(labels.filter(F.col(label).isNotNull()), "doc_id")
    rows = both.select(label, "predicted").toPandas()
    assert len(rows) > 400
    recall = rows[rows[label] == 1]["predicted"].mean()
    return (rows[label] == rows["predicted"]).mean(), recall


@pytest.fixture(scope="module")
def field(tables):
    return quality.fit_quality(tables["documents"], tables["labels"])


def test_quality_on_held_out_documents(tables, field):
    scored = quality.score_quality(tables["documents"], field)
    accuracy, recall = _accuracy(scored, tables["labels"], "quality")
    assert accuracy > 0.97 and recall > 0.97


def test_quality_of_odd_rows(spark, field):
    docs = spark.createDataFrame(ODD, SCHEMA)
    found = quality.score_quality(docs, field).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    assert found[3]["score"] == found[4]["score"] and found[0]["score"] == found[1]["score"]
    assert quality.score_quality(docs.limit(0), field).count() == 0
    kept = quality.keep_good(docs, field)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["predicted"] for r in found)


def test_quality_without_labels(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality(docs, none)
    assert quality.score_quality(docs, model).filter("predicted = 1").count() == len(ODD)


def test_class_shares_of_a_very_long_line():
    n = (1 << 21) + 5
    x, lengths, _ = quality.line_features(["a" * n + "B" * 3, "cd1 "])
    assert lengths.tolist() == [n + 3, 4]
    assert np.allclose(x[0, :7] * lengths[0], [n, 3, 0, 0, 0, 0, 0], atol=0.5)
    assert np.allclose(x[1, :7] * 4, [2, 0, 1, 1, 0, 0, 0])


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(1)
    sizes = np.array([3, 1, 4])
    scores, step, start = r.standard_normal(8), r.standard_normal((2, 2)), r.standard_normal(2)
    found, _ = quality.forward_backward(scores, sizes, step, start)
    at = 0
    for n in sizes:
        total, good = 0.0, np.zeros(n)
        for code in range(2**n):
            path = [(code >> i) & 1 for i in range(n)]
            energy = start[path[0]] + sum(scores[at + i] * path[i] for i in range(n))
            energy += sum(step[a, b] for a, b in zip(path, path[1:]))
            total += np.exp(energy)
            good += np.exp(energy) * np.array(path)
        assert np.allclose(found[at : at + n, 1], good / total)
        at += n


@pytest.mark.parametrize("n", [1, 2, 3, 10, 401, 5000])
def test_long_texts_have_the_same_marginals(n):
    r = np.random.default_rng(n)
    scores, step, start = r.normal(0, 8, n), r.normal(0, 2, (2, 2)), r.normal(size=2)
    plain, _ = quality.forward_backward(scores, np.array([n]), step, start)
    assert np.allclose(quality.long_marginals(scores, step, start), plain, atol=1e-9)


def test_whole_scores_weigh_lines_by_length(spark, tables, monkeypatch):
    model = quality.fit_quality(tables["documents"].limit(300), tables["labels"])
    texts = ["", "one line", "A first line.\n\nzz ## 99\nThe last, longer line of the text.", "x\n" * 3000, "Good words here.\n" * 1500 + "junk @@@@ 1234\n" * 900]
    expected = []
    for text in texts:
        x, lengths, per_text = quality.line_features([text])
        scaled = quality.with_neighbours((x - model.mean) / model.spread, per_text)
        good = quality.forward_backward(scaled @ model.weights, per_text, model.step, model.start)[0][:, 1]
        expected.append(sum(g * (n + 1) for g, n in zip(good, lengths, strict=True)) / sum(n + 1 for n in lengths))
    assert np.allclose(model.score(texts), np.clip(expected, 0, 1), atol=1e-9)
    monkeypatch.setattr(quality, "LONG_LINES", 1)
    assert np.allclose(model.score(texts), np.clip(expected, 0, 1), atol=1e-9)


def test_very_many_lines_take_seconds():
    scores = np.random.default_rng(1).normal(size=2_000_000)
    began = time.process_time()
    quality.long_marginals(scores, np.array([[0.5, -0.5], [-0.5, 0.5]]), np.zeros(2))
    assert time.process_time() - began < 20


def test_detector_gradients_equal_differences():
    texts = ["one two three", "you are a moron", "", "a b c d e f g " * 9]
    model, words = toxicity.Detector(3), toxicity.read_words(texts)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    numbers, filled, count = toxicity.windows(words)
    used, some = np.unique(numbers, return_inverse=True)
    part, some = toxicity.only(words, used), some.reshape(numbers.shape)
    y = np.arange(len(numbers)) % 2

    def loss():
        logit = model.run(model.project(part)[1], some, filled)
        return float(np.mean(np.logaddexp(0, logit) - y * logit))

    vectors, projected = model.project(part)
    logit, kept = model.run(projected, some, filled, keep=True)
    grads = model.back(part, vectors, some, filled, kept, (toxicity._sigmoid(logit) - y) / len(y))
    r = np.random.default_rng(0)
    for name, g in grads.items():
        for _ in range(4):
            at = tuple(r.integers(s) for s in g.shape)
            if name in ("word", "char"):
                at = tuple(np.argwhere(g)[r.integers(len(np.argwhere(g)))])
            held = model.p[name][at]
            model.p[name][at] = held + 1e-3
            up = loss()
            model.p[name][at] = held - 1e-3
            down = loss()
            model.p[name][at] = held
            assert np.isclose(g[at], (up - down) / 2e-3, atol=1e-3), name


def test_both_forward_passes_agree():
    model = toxicity.Detector(9)
    words = toxicity.read_words(["", "one", " ".join(f"w{i % 17}" for i in range(150)), "a b c " * 15])
    numbers, filled, _ = toxicity.windows(words)
    projected = model.project(words)[1]
    assert np.allclose(model.score_windows(projected, numbers, filled), model.run(projected, numbers, filled), atol=1e-5)


def test_toxicity_on_held_out_documents(spark, tables):
    model = toxicity.fit_toxicity(tables["documents"], tables["labels"])
    scored = toxicity.score_toxicity(tables["documents"], model)
    accuracy, recall = _accuracy(scored, tables["labels"], "toxic")
    assert accuracy > 0.95 and recall > 0.8
    docs = spark.createDataFrame(ODD, SCHEMA)
    found = toxicity.score_toxicity(docs, model).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    assert found[3]["score"] == found[4]["score"] and found[0]["score"] == found[1]["score"]
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_windows_reach_every_word():
    for n in (0, 1, 31, 32, 33, 58, 59, 200):
        words = toxicity.read_words(["x", " ".join(f"w{i}" for i in range(n)), "y z"])
        numbers, filled, count = toxicity.windows(words)
        own = slice(count[0], count[0] + count[1])
        assert len(set(numbers[own][filled[own]].tolist())) == n


def test_a_passage_lies_whole_in_a_window_wherever_it_stands():
    whole = toxicity.WINDOW - toxicity.STRIDE + 1
    passage = [f"p{i}" for i in range(whole)]
    for n in range(60):
        for behind in range(0, 70, 7):
            words = toxicity.read_words([" ".join(["x"] * n + passage + ["y"] * behind)])
            begin, stop, _ = toxicity.window_places(words)
            assert ((begin <= n) & (np.minimum(begin + toxicity.WINDOW, stop) >= n + whole)).any()


def test_a_window_scores_alike_wherever_it_stands():
    model = toxicity.Detector(5)
    passage = [f"p{i}" for i in range(toxicity.WINDOW)]
    alone = model.score([" ".join(passage)])[0]
    for n in range(0, 60, toxicity.STRIDE):
        assert model.score([" ".join(["x"] * n + passage + ["x"] * 70)])[0] >= alone - 1e-6


PAGE = (
    '<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href="/">Home</a></nav>'
    "{main}<aside class=sidebar><p>Side words here</p></aside><form><label>Mail</label></form>"
    '<section id="comments"><p>Nice post, thank you</p></section><footer>&copy; x</footer></body></html>'
)
BODY = "<h1>Head &amp; tail</h1><p>First  para<br>goes\non <b>bold</b> text" + " more" * 40 + "<p>Second &lt;one&gt;.</p>"
TEXT = "Head & tail\n\nFirst para goes on bold text" + " more" * 40 + "\n\nSecond <one>."


@pytest.fixture(scope="module")
def extractor(tables):
    return markup.fit_extractor(tables["pages"])


@pytest.mark.parametrize("tag", ["<article>{}</article>", '<div class="post-content">{}</div>', "<main>{}</main>"])
def test_main_text_of_pages(extractor, tag):
    assert markup.main_text([PAGE.format(main=tag.format(BODY))], extractor) == [TEXT]


def plain_article(page):
    """Text of the page's one article by cutting markup with patterns alone."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    inner = re.sub(r"<(script|style|nav|aside|form|footer|header)\b.*?</\1>", "<p>", inner, flags=re.S)
    inner = re.sub(r"<!--.*?-->", "", inner, flags=re.S)
    blocks = re.split(r"</?(?:p|h\d|div|ul|ol|li|blockquote|pre|table|tr|td|th|section|figure|figcaption)\b[^>]*>", inner)
    texts = (html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"<br\s*/?>", " ", b))) for b in blocks)
    return "\n\n".join(t for t in (" ".join(t.split()) for t in texts) if t)


def test_articles_of_given_pages_come_out_whole(tables, extractor):
    pages = [r["html"] for r in tables["pages"].select("html").collect()]
    found = markup.main_text(pages, extractor)
    wrong = [i for i, (p, t) in enumerate(zip(pages, found, strict=True)) if plain_article(p) != t]
    assert len(pages) > 100 and not wrong


def test_line_breaks_part_words_only_where_they_stand():
    tree = markup.parse("<p>un<b>believ</b>able<br>x<i>y</i>z<br/>w</p><div>a<br>b</div>")
    assert markup.kept_text(tree, np.ones(len(tree.tag), bool)) == "unbelievable xyz w\n\na b"


def test_end_tags_close_what_they_may():
    tree = markup.parse("<div><p>a<span>b</p>c</span></i>d<ul><li>e<li>f<ul><li>g</ul>h</ul></div><td>i</tr>j")
    text = [(tree.tag[node], t) for node, t in tree.text]
    assert text == [("p", "a"), ("span", "b"), ("div", "c"), ("div", "d"), ("li", "e"), ("li", "f"), ("li", "g"), ("li", "h"), ("td", "i"), ("td", "j")]


@pytest.mark.parametrize("page", ["<span>" * 60_000 + "</x>" * 60_000, "<b><div>" + "<span>" * 60_000 + "</b>" * 60_000, "<p>" * 60_000 + "</p>" * 60_000])
def test_broken_nesting_takes_linear_time(page):
    began = time.process_time()
    markup.parse(page)
    assert time.process_time() - began < 5


def test_extraction_of_odd_pages(spark, extractor):
    rows = [(1, None, None, "a"), (2, "u", "", "b"), (None, "v", "<article><p>cut &am", "c"), (4, "w", "plain < text", "d"),
            (5, "x", "<script>" + "x" * 300_000, "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = markup.extract_text(pages, extractor).collect()
    assert [r["text"] for r in found][:2] == ["", ""] and found[2]["text"] == "cut &am"
    assert found[4]["text"] == "" and all(r["n_chars"] == len(r["text"]) for r in found)
    assert markup.extract_text(pages.limit(0), extractor).count() == 0


def test_no_kept_node_below_a_dropped_one(tables, extractor):
    for row in tables["pages"].limit(50).collect():
        tree = markup.parse(row["html"] or "")
        keep = markup.decode(tree, extractor.logit(markup.node_features(tree)))
        assert all(keep[p] or not keep[i] for i, p in enumerate(tree.parent) if p >= 0)


def _brute_secrets(text):

    found = []
    for kind, pattern, group, least in (
        ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
    ):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m[group]) >= least:
                found.append((m.start(), ("assign", "access", "hex").index(kind), m.end()))
    return sorted(found)


def test_secrets_equal_a_plain_scan(spark, tables):
    extra = [
        (1, None), (2, ""), (3, "é password=abc token=xyz123456 secret=token: abcdef1"), (4, "API_KEY: 'abcdefgh'😀 AKIA" + "Z9" * 9),
        (5, "x" * 50_000 + " token=abcdef9 " + "0a" * 12 + " " + "f" * 23), (None, "PassWord = \"aaaaaa\"" * 300), (7, "AKIAAKIA" + "B" * 15),
        (8, "pw kJ8dLq0Zx3TnV7bR1mYs is here"), (9, "the_ordinary_identifier_name_of_2_things is here"),
    ]
    docs = spark.createDataFrame(extra, "doc_id long, text string")
    docs = docs.unionByName(tables["documents"].select("doc_id", "text"))
    model = secrets.fit_runs(secrets.labelled_samples(tables["documents"]))
    found = secrets.find_secrets(docs, model).collect()
    texts = [r["text"] for r in docs.collect()]
    assert len(found) == len(texts)
    for row, text in zip(found, texts):
        base = [(s["start"], s["kind"], s["end"]) for s in row["spans"] if s["kind"] < 3]
        assert base == _brute_secrets(text), text
    assert [s["kind"] for s in found[7]["spans"]] == [3] and not found[8]["spans"]
    assert secrets.find_secrets(docs.limit(0), model).count() == 0
