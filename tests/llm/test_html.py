"""Blocks of pages, the network that classifies them, and main texts."""

import html as htmllib
import re

import numpy as np
import pytest

from tidemark.llm import blocklstm, maintext, queries
from tidemark.llm.htmlblocks import Block, blocks, element_buckets
from tidemark.llm.layouts import MARK, Layouts

SCHEMA = "page_id long, url string, html string, text string, n_chars string, words int"


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("", []),
        (" \n\t ", []),
        ("plain &lt;text&gt;", ["plain <text>"]),
        ("<p>a<b>c</b>d<p>x &amp;&nbsp;\n y<br>z</p></div>tail", ["acd", "x & y z", "tail"]),
        ("<ul><li>a<li><a href=x>b</a> c</ul><!-- x <p>no", ["a", "b c"]),
        ('<script>var t="</p>";</script>q < r <3<style>p{}</style>', ["q < r <3"]),
        ("<title>t</title><p title=\"a>b\" class='c>d'>k</p><a href=\"u", ["k"]),
        ("a</p>b<textarea>x</textarea>c<SELECT><option>1<option>2</select>", ["a", "b", "c", "1", "2"]),
        ("<table><tr><td>1<td>2<tr><th>3</table>", ["1", "2", "3"]),
        ("<p><b>one<br><p>two</b> three</p>", ["one", "two three"]),
        ("<p title=it's>x</p><p>y</p>", ["x", "y"]),
        ("<script>never ends <p>x", []),
        ("<div>x<b></i></p></section></div>&#128578; &bogus;", ["x", "🙂 &bogus;"]),
    ],
)
def test_blocks(page, expected):
    assert [b.text for b in blocks(page)] == expected


def test_paths_and_links():
    page = '<div class="siteNav top-links" id=Main><p>a <a href=x>bc</a></p></div>'
    [block] = blocks(page)
    words = [element_buckets(w, "") for w in ("div", "site", "nav", "top", "link", "main", "p")]
    assert frozenset().union(*words) <= block.path[0] | element_buckets("", "")
    assert block.path[1] == element_buckets("p", "") and block.linked == 2


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<p><b>x" * 20_000, '<a "' * 20_000 + "x>y", "<" * 100_000])
def test_malformed_pages_take_no_longer(page):
    assert blocks(page) is not None


def random_pages(rng, n):
    out = []
    for _ in range(n):
        page = []
        for _ in range(int(rng.integers(0, 9))):
            path = tuple(frozenset(rng.integers(0, 1024, 3).tolist()) for _ in range(2))
            page.append(Block(" ".join(f"w{i}" for i in rng.integers(0, 50, int(rng.integers(1, 6)))), path, 0))
        out.append(page)
    return out


def test_pages_side_by_side_equal_one_step_at_a_time():
    rng = np.random.default_rng(1)
    pages, w = random_pages(rng, 30), {k: v.astype(np.float64) for k, v in blocklstm.start(3).items()}
    got = blocklstm.probabilities(w, pages, {})

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    n = blocklstm.HIDDEN
    for page, found in zip(pages, got):
        logits = np.full(len(page), float(w["out"][0]))
        features = blocklstm.sequences([page], {}).features
        for side in "fb":
            h, c = np.zeros(n), np.zeros(n)
            for t in range(len(page)) if side == "f" else reversed(range(len(page))):
                around, own = page[t].path
                z = w[f"bias_{side}"] + features[t] @ w[f"text_{side}"] + h @ w[f"back_{side}"]
                z = z + w[f"around_{side}"][list(around)].sum(0) + w[f"own_{side}"][list(own)].sum(0)
                i, f, o = (sigmoid(z[k * n : (k + 1) * n]) for k in range(3))
                c = f * c + i * np.tanh(z[3 * n :])
                h = o * np.tanh(c)
                logits[t] += h @ w[f"out_{side}"]
        np.testing.assert_allclose(found, sigmoid(logits), atol=1e-5)


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(blocklstm.np, "float32", np.float64)
    rng = np.random.default_rng(2)
    pages = [p for p in random_pages(rng, 5) if p]
    w = {k: v.astype(np.float64) for k, v in blocklstm.start(4).items()}
    seq = blocklstm.sequences(pages, {})
    labels = rng.integers(0, 2, len(seq.path)).astype(float)
    _, grads = blocklstm.loss_and_gradients(w, seq, labels)
    for name, grad in grads.items():
        for at in map(tuple, rng.permutation(np.argwhere(np.abs(grad) > 1e-7))[:4]):
            sides = []
            for step in (1e-4, -1e-4):
                moved = {k: v.copy() for k, v in w.items()}
                moved[name][at] += step
                sides.append(blocklstm.loss_and_gradients(moved, seq, labels)[0])
            assert abs((sides[0] - sides[1]) / 2e-4 - grad[at]) < 1e-4


@pytest.fixture(scope="module")
def weights(spark, sf_dir):
    return maintext.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def test_main_texts_of_table(spark, sf_dir, weights):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in maintext.main_texts(pages, weights).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article)
        said = [" ".join(htmllib.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        row = got[page.page_id]
        assert row.text == "\n".join(filter(None, said)) and row.n_chars == len(row.text) and row.url == page.url


def test_held_out_layouts(spark, sf_dir, weights):
    html = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").limit(40).collect()]
    texts = [b.text for h in html for b in blocks(h) if len(b.text) > 40]
    layouts = Layouts(texts, np.random.default_rng(12345))
    pages = [blocks(layouts.page()) for _ in range(300)]
    gold = np.concatenate([[b.text.startswith(MARK) for b in p] for p in pages])
    plain = [[maintext.unmarked(b) for b in p] for p in pages]
    found = np.concatenate(blocklstm.probabilities(maintext.unpacked(weights), plain, {})) >= 0.5
    assert found[gold].mean() > 0.98 and (~found[~gold]).mean() > 0.98


def test_main_texts_of_odd_rows(spark, weights):
    body = "<nav><a href=/>Home</a></nav><article><h1>Title of this text</h1><p>A text &amp; more.</p></article>"
    many = "".join(f"<p>Some {i} words in a paragraph of a text.</p>" for i in range(30_000))
    long = body.replace("</article>", many + "</article>")
    rows = [(1, "u", body), (1, "u", body), (2, None, body), (None, "u", body), (3, "u", None), (4, "u", ""), (5, "u", long)]
    pages = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)
    got = maintext.main_texts(pages, weights)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in got.collect()}
    assert got.count() == len(rows)
    expected = "Title of this text\nA text & more."
    assert found[1, "u"] == found[2, None] == found[None, "u"] == (expected, len(expected))
    assert found[3, "u"] == found[4, "u"] == ("", 0)
    # A whole text, however long; a classifier may err on a few blocks of it.
    assert found[5, "u"][0].count("\n") > 29_000 and "Some 29999 words" in found[5, "u"][0]
    assert maintext.main_texts(pages.limit(0), weights).collect() == []


def test_fit_without_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert maintext.unpacked(maintext.fit(empty)).keys() == blocklstm.start(1).keys()


def test_registered_query(spark, sf_dir):
    got = queries.op11_html_extraction(spark, sf_dir)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert got.count() == pages.count() and got.where("text = ''").count() == 0
