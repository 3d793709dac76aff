"""The site style tree against entropies worked out page by page, and markup that names mislead about."""

import collections
import math

import pytest

from ratewright.llm import sitestyle
from ratewright.llm.queries import importable

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    importable(spark)


@pytest.mark.parametrize(
    "html, text",
    [
        ('<div class="layout has-sidebar"><article><p>The article text.', "The article text."),
        ('<div class="post no-comments"><article><p>A</p></article></div><div class="sidebar">S</div>', "A"),
        ('<form action="/x"><nav>N</nav><article><p>A</p></article><footer>F</footer></form>', "A"),
        ('<article class="post no-comments"><p>A</p></article>', "A"),
        ('<article><p class="ad hoc">A</p><p id="share">B</p><h2 class="notice">C</h2><ul class="menu"><li>D</ul></article>', "A\nB\nC\nD"),
        ('<article><p>One <math><mi>x</mi></math> two <label>three</label> four</p></article>', "One x two three four"),
        ('<article><p>One <script>no()</script>two<style>p{}</style> <svg><text>no</text></svg>three</p></article>', "One two three"),
        # names still judge what is beside the article, and blocks of others inside it
        ('<div class="ad">X</div><article><p>A</p><div class="share">S</div><div class="related"><p>R</p></div></article>', "A"),
        ('<article><p>A</p></article><div class="related"><article><p>Other</p></article></div>', "A"),
        ('<main><p>A</p></main><aside><article><p>Teaser</p></article></aside>', "A"),
        ('<article><p>A</p><article class="comment"><p>First!</p></article></article>', "A"),
        ('<div hidden><article><p>A</p></article></div><p>B</p>', "B"),
        ('<div class="comments"><p>Only a comment</p></div>', ""),
        ("<article><nav>N</nav></article>", ""),
    ],
)
def test_names_do_not_cost_the_article(html, text):
    assert sitestyle.main_text(html) == text


def pages_of_a_host(n=9):
    return [
        f'<body><div class="top">Welcome</div><ul class="links"><li>Link {i % 3}</li><li>About</li></ul>'
        f'<div class="text"><p>Story {i}</p>{"<p>More</p>" if i % 2 else ""}</div><div class="end">Bye {i // 5}</div></body>'
        for i in range(n)
    ]


def brute_importance(pages):
    features = collections.defaultdict(collections.Counter)
    for page in pages:
        for path, kind, feature in sitestyle.page_nodes(page):
            features[path, kind][feature] += 1
    out = {}
    for node, counts in features.items():
        m = sum(counts.values())
        entropy = -sum(n / m * math.log(n / m, m) for n in counts.values()) if m > 1 else 1.0
        out[node] = (m, entropy)
    return out


def brute_removed(importance):
    removed = set()
    for branch in {b for path, kind in importance if kind == 1 for b in sitestyle.branches(path)}:
        leaves = [v for (path, kind), v in importance.items() if kind == 1 and (path == branch or path.startswith(branch + "/"))]
        content = sum(m * e for m, e in leaves) / sum(m for m, _ in leaves)
        style = importance.get((branch, 0), (0, None))[1]
        total = content if style is None else (1 - sitestyle.DECAY) * style + sitestyle.DECAY * content
        if max(m for m, _ in leaves) >= sitestyle.PAGES and total < sitestyle.THRESHOLD:
            removed.add(branch)
    return removed


def frame(spark, pages, host="h.org"):
    rows = [(i, f"http://{host}/{i}", page, "x", 1) for i, page in enumerate(pages)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, path string, n int")


@pytest.mark.parametrize("held", [100_000, 3])
def test_importance_and_removed_branches(spark, monkeypatch, held):
    monkeypatch.setattr(sitestyle, "_NODES_HELD", held)
    pages = pages_of_a_host()
    expected = brute_importance(pages)
    got = {(r.path, r.kind): (r.pages, r.importance) for r in sitestyle.node_importance(frame(spark, pages)).collect()}
    assert set(got) == set(expected)
    assert all(got[k] == (expected[k][0], pytest.approx(expected[k][1], abs=1e-9)) for k in expected)
    (row,) = sitestyle.low_branches(frame(spark, pages)).collect()
    assert set(row.removed) == brute_removed(expected)
    assert "/body/div.top" in row.removed and "/body/div.text" not in row.removed
    texts = [r.text for r in sitestyle.extract_main_text(frame(spark, pages)).orderBy("page_id").collect()]
    assert all(t.splitlines()[0] != "Welcome" and f"Story {i}" in t for i, t in enumerate(texts))


def test_the_tree_of_the_sample_pages_is_not_empty(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    nodes = sitestyle.node_importance(pages)
    kinds = {r.kind: r["count"] for r in nodes.groupBy("kind").count().collect()}
    assert kinds[0] > 0 and kinds[1] > 0
    assert nodes.where("importance < -1e-9 OR importance > 1 + 1e-9").count() == 0
    extracted = sitestyle.extract_main_text(pages)
    assert extracted.count() == pages.count() and extracted.where("text LIKE '%<%p>%'").count() == 0


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://a/", "<p>x"), (2, "no host", "<p>y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert sorted((r.page_id is None, r.text, r.n_chars) for r in sitestyle.extract_main_text(pages).collect()) == [
        (False, "", 0), (False, "", 0), (False, "y", 1), (True, "x", 1),
    ]
    assert sitestyle.extract_main_text(pages.limit(0)).collect() == []


def test_a_long_deep_page():
    deep = "<div>" * 400 + "<article>" + "".join(f"<p>Paragraph {i} of the story.</p>" for i in range(20_000)) + "</article>"
    text = sitestyle.main_text(deep)
    assert text.count("\n") == 19_999 and text.endswith("Paragraph 19999 of the story.")
