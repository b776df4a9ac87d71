"""Blocks of pages by worked cases, the LSTM against its definition, main text against a plain extractor."""

import time
from html.parser import HTMLParser

import numpy as np
import pytest

from lexloom.llm import extraction, layouts, lstm, queries


def texts(html):
    return [t for _, t, _ in extraction.leaves(html, extraction.Paths())]


@pytest.mark.parametrize("html, expected", [
    ("", []),
    ("plain", ["plain"]),
    ("<p>a<p>b</p>c", ["a", "b", "c"]),
    ("<p><b>a<br><p>b &amp; c &lt;d&gt; &eacute;&#8364;&nbsp;e", ["a", "b & c <d> é€ e"]),
    ("<p>a <i>b</i>\n\t c<br>d</p>", ["a b c d"]),
    ("<p>un<b>der</b>line</p>", ["underline"]),
    ("a<!-- <p>x</p> -->b<!---->c<!-->d", ["abcd"]),
    ("a<!-- never ends <p>b", ["a"]),
    ('<script>var t="</p>";if(a<b)x()</script><p>a<style>p{}</style></p>', ["a"]),
    ("<SCRIPT>x</script ><P>a</P><script>y", ["a"]),
    ("<title>t</title><head><p>x</p></head><body>b</body>", ["b"]),
    ("<noscript><p>x</p></noscript><svg><p>y</svg><template><div>z</div></template>a", ["a"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("1 < 2 <3 a<b>c</b> </ x> <?php x ?>d", ["1 < 2 <3 ac </ x> d"]),
    ('<p title="a>b" class=\'c>d\'>e</p>', ["e"]),
    ('<p title="a>b</p><p>c</p>', ["b", "c"]),
    ("a<p unfinished", ["a"]),
    ("<p>a &amp b &am</p>", ["a & b &am"]),
    ("a<hr>b<custom>c</custom><wbr>d", ["a", "bcd"]),
])
def test_blocks(html, expected):
    assert texts(html) == expected


def test_links_and_paths():
    paths = layouts._Trail()
    found = extraction.leaves('<div class="a b"><ul id=m><li><a href=x>one</a> two</ul>three</div>', paths)
    assert [(t, n) for _, t, n in found] == [("one two", 3), ("three", 0)]
    assert paths.names[found[0][0]] == ("<div> a b", "<ul> m", "<li>")


@pytest.mark.parametrize("html, count", [
    ("<div>" * 300_000 + "x", 1),
    ("<p>x" * 200_000, 200_000),
    ("<p>" + "word " * 400_000, 1),
    ('<a "' * 200_000, 0),
    ("<a '\"" * 200_000 + "<p>x", None),
    ("<" * 500_000, 1),
    ("<!--" * 200_000, 0),
    ("<script>" * 100_000, 0),
    ("<li>" * 100_000 + "x", 1),
])
def test_long_pages_take_linear_time(html, count):
    begin = time.monotonic()
    found = texts(html)
    assert time.monotonic() - begin < 10
    assert count is None or len(found) == count


def small(rng, hidden=3, width=4):
    model = lstm.blank(width, hidden, 1)
    for v in model.parameters():
        v[...] = rng.normal(0, 0.5, v.shape)
    return model


def plain_scores(model, x):
    """One number after the other."""
    def run(d, steps):
        n = len(d.head)
        h, c, out = [0.0] * n, [0.0] * n, {}
        for t in steps:
            z = [sum(x[t, i] * d.wx[i, j] for i in range(x.shape[1])) + sum(h[i] * d.wh[i, j] for i in range(n)) + d.b[j] for j in range(4 * n)]
            gate = [1 / (1 + np.exp(-v)) for v in z[: 3 * n]]
            c = [gate[n + i] * c[i] + gate[i] * np.tanh(z[3 * n + i]) for i in range(n)]
            h = [gate[2 * n + i] * np.tanh(c[i]) for i in range(n)]
            out[t] = sum(a * b for a, b in zip(h, d.head))
        return out

    ahead, back = run(model.ahead, range(len(x))), run(model.back, range(len(x) - 1, -1, -1))
    return [ahead[t] + back[t] + float(x[t] @ model.own) + float(model.bias[0]) for t in range(len(x))]


@pytest.mark.parametrize("cells", [1, 60, 4_000_000])
def test_scores_of_many_sequences(monkeypatch, cells):
    rng = np.random.default_rng(0)
    model = small(rng)
    lengths = np.array([3, 0, 7, 1, 12, 3])
    x = rng.normal(size=(lengths.sum(), 4)).astype(np.float32)
    monkeypatch.setattr(lstm, "CELLS", cells)
    found = lstm.scores(model, lengths, lambda items: x[items])
    ends = np.concatenate([[0], np.cumsum(lengths)])
    expected = [s for a, b in zip(ends, ends[1:]) for s in plain_scores(model, x[a:b])]
    assert np.allclose(found, expected, atol=1e-4)


def test_gradients_are_slopes():
    rng = np.random.default_rng(1)
    model = small(rng)
    for part in (model.ahead, model.back):
        for name, v in vars(part).items():
            setattr(part, name, v.astype(float))
    model.own, model.bias = model.own.astype(float), model.bias.astype(float)
    x, y = rng.normal(size=(5, 3, 4)), rng.integers(0, 2, (5, 3)).astype(float)
    there = np.arange(5)[:, None] < np.array([5, 2, 4])[None]
    _, grads = lstm.loss_and_gradients(model, x, there, y)
    for v, g in zip(model.parameters(), grads):
        for at in {0, v.size // 2, v.size - 1}:
            keep = v.flat[at]
            v.flat[at] = keep + 1e-5
            up, _ = lstm.loss_and_gradients(model, x, there, y)
            v.flat[at] = keep - 1e-5
            down, _ = lstm.loss_and_gradients(model, x, there, y)
            v.flat[at] = keep
            assert abs((up - down) / 2e-5 - g.flat[at]) < 1e-4


class Article(HTMLParser):
    """Text of an article, a line for each block, by another parser."""

    def __init__(self, html):
        super().__init__()
        self.inside, self.lines = False, [""]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        self.lines += [""] * (tag in ("article", "p", "h1"))
        self.lines[-1] += " " * (tag == "br")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        self.lines += [""] * (tag in ("article", "p", "h1"))

    def handle_data(self, data):
        if self.inside:
            self.lines[-1] += data

    def text(self):
        return "\n".join(" ".join(x.split()) for x in self.lines if x.strip())


def test_query_on_all_pages(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    found = {r.page_id: r for r in queries.QUERIES["op13_extraction"](spark, sf).collect()}
    assert len(found) == len(rows)
    same = 0
    for r in rows:
        got = found[r.page_id]
        assert got.url == r.url and got.n_chars == len(got.text)
        same += got.text == Article(r.html).text()
    assert same >= 0.99 * len(rows)


@pytest.fixture(scope="module")
def labeller():
    import pyarrow.parquet as pq

    html = pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["html"]).column(0).to_pylist()
    return extraction.fit_labeller(html[:240]), html[1_000:1_200]


def test_layouts_never_seen(labeller):
    """Blocks of held-out pages under drawn layouts, and the named parts of one written by hand."""
    model, held = labeller
    rng = np.random.default_rng(77)
    marks = [layouts.marked(h, extraction.leaves) for h in held]
    main, rest = [[t for t, y in m if y] for m in marks], [t for m in marks for t, y in m if not y]
    sentences = [t for some in main for t in some]
    right = total = 0
    for some in main:
        html, truth = layouts.page(rng, some, sentences, rest)
        kept = set(extraction.main_text(model, [html])[0].split("\n"))
        right += sum((t in kept) == y for t, y in truth)
        total += len(truth)
    assert right > 0.95 * total
    page = (
        "<html><body><header class='site-header'><h2>{0}</h2><nav><ul><li><a href=/>{1}</a></li><li><a href=/b>Home</a></li></ul></nav></header>"
        "<div class='cookie-notice'><p>We use cookies to improve your experience.</p></div>"
        "<main><h1>{2}</h1><p>{3}</p><div class='advert'>{4}</div><p>{5}</p><p>{6}</p></main>"
        "<aside class=sidebar><h3>Related articles</h3><ul><li><a href=/c>{7}</a></li></ul></aside>"
        "<form class=newsletter><p>{8}</p><button>Sign up</button></form>"
        "<section class=comments><div class=comment><p>{9}</p></div><div class=comment><p>{10}</p></div></section><footer><p>{11}</p></footer></body></html>"
    ).format(*sentences[:12])
    assert extraction.main_text(model, [page])[0].split("\n") == [sentences[i] for i in (2, 3, 5, 6)]


def test_odd_rows(spark, labeller):
    model, held = labeller
    rows = [(1, None, "u", "old", 5, 0), (1, None, "u", "old", 5, 0), (None, "", None, "old", 5, 0), (3, "<script>x</script>", "u", None, 5, 0), (4, held[0], "u", "old", 5, 0), (4, held[0], "u", "old", 5, 0)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, text string, n_chars long, path int")
    found = extraction.extract(pages, model)
    assert sorted(found.columns) == sorted(pages.columns)
    got = sorted((r.page_id or 0, r.text, r.n_chars, r.path) for r in found.collect())
    main = Article(held[0]).text()
    assert got == [(0, "", 0, 0), (1, "", 0, 0), (1, "", 0, 0), (3, "", 0, 0), (4, main, len(main), 0), (4, main, len(main), 0)]
    assert extraction.extract(pages.limit(0), model).count() == 0
    assert extraction.sample_pages(pages.limit(0)) == []
    assert extraction.fit_labeller([]) is None and extraction.fit_labeller(["<p>no article</p>"]) is None
    assert {r.text for r in extraction.extract(pages, None).collect()} == {""}
