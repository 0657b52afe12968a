import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm.mixing import cuts, mix
from kinfold.llm.pages import main_text, read_page
from kinfold.llm.vantage import nearest
from tests.llm.conftest import awkward, document, prose, table


def shares(sizes, weights=(5, 2, 1), factor=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, rest, free = {}, factor * sum(sizes.values()), set(names)
    while free:
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= most * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in free}
        target |= {s: most * sizes[s] for s in full}
        rest -= sum(target[s] for s in full)
        free -= full
    return target


WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("range_rows", [4096, 3])
def test_mix(spark, monkeypatch, range_rows):
    from kinfold.llm import mixing

    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    rows = [document(k, prose(k, 5 + k % 90), "en", ["a", "b", "c", None, "a", "a"][k % 6]) for k in range(100, 700)] + awkward()
    docs = table(spark, rows, extra=True)
    mixed, decided = mix(docs)
    assert mixed.columns == docs.columns
    got = decided.collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    target = shares(sizes)
    taken, longest = collections.Counter(), collections.Counter()
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], target[s], rel_tol=1e-9)
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and (target[s] < sizes[s] or r["taken"] >= r["size"])
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in sizes)
    assert sorted(map(str, mix(docs)[1].collect())) == sorted(map(str, got))
    times = collections.Counter(r["doc_id"] for r in mixed.collect() if WORD.search(r["text"] or ""))
    assert times == collections.Counter(r["doc_id"] for r in got for _ in range(r["taken"] // max(r["size"], 1)))


@pytest.mark.parametrize("seed", [7, 8, 9])
def test_mix_takes_part_of_a_repeated_row(spark, seed):
    """One row in a third of a source: the sum still ends within a document of the target, and reruns agree."""
    rows = [document(k if k >= 1000 else 5, " ".join(["w"] * 50), "en", "a") for k in range(3000)]
    rows += [document(k, " ".join(["w"] * 40), "en", None) for k in range(4000, 6500)]
    docs = table(spark, rows, extra=True).repartition(7)
    mixed, decided = mix(docs, seed=seed, weights=(5, 5), factor=1.25)
    sums = {r["source_size"]: r["taken"] for r in decided.groupBy("source_size").agg(F.sum("taken").alias("taken")).collect()}
    goals = {r["source_size"]: r["target"] for r in decided.select("source_size", "target").distinct().collect()}
    assert all(abs(sums[s] - goals[s]) <= 50 for s in (150_000, 100_000))
    assert mixed.filter("source = 'a'").count() * 50 == sums[150_000]
    again = mix(docs, seed=seed, weights=(5, 5), factor=1.25)[1]
    assert sorted(map(str, again.collect())) == sorted(map(str, decided.collect()))


def test_mix_prefers_quality(spark):
    rows = [(k, "w " * 50, "a", 1.0 if k % 2 else 0.1) for k in range(400)] + [(999, "w " * 20_000, "b", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double")
    mixed = mix(docs, weights=(1, 40), factor=0.4, quality="quality")[0].filter("source = 'a'").collect()
    assert mixed and np.mean([r["quality"] for r in mixed]) > 0.8


def test_mix_nothing(spark, empty):
    assert [x.count() for x in mix(empty)] == [0, 0]
    assert [r["taken"] for r in mix(table(spark, [document(1, None), document(2, " ")]))[1].collect()] == [0, 0]


def product(x, y):
    total = 0.0  # sum() would compensate for rounding
    for a, b in zip(x, y):
        total += a * b
    return total


def brute(rows, k):
    found = []
    for q, x in rows:
        if q is None or q % 20:
            continue
        best = sorted((-product(x, y), i) for i, y in rows if i is not None and i != q)
        found += [(q, r, i, -s) for r, (s, i) in enumerate(best[:k], 1)]
    return sorted(found)


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.withColumns({n: F.lit(1) for n in ("shard", "kind", "vector", "score", "rank")})


@pytest.mark.parametrize("shard_rows", [16_384, 150])
def test_nearest_is_exact_at_factor_one(spark, monkeypatch, shard_rows):
    from kinfold.llm import vantage

    monkeypatch.setattr(vantage, "SHARD_ROWS", shard_rows)
    draw = np.random.default_rng(3)
    clustered = draw.normal(size=(12, 6))[draw.integers(0, 12, 900)] + 0.1 * draw.normal(size=(900, 6))
    rows = [(k, v.tolist()) for k, v in enumerate(clustered)]
    rows += [(1000 + k, [1.0, 0.5, 0.0, 0.0, 0.0, 2.0]) for k in range(400)]  # one vector in a third of the rows
    odd = [(2000, None), (2020, [0.0] * 6), (2040, [float("nan")] * 6), (2060, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2080, []), (2100, [1.0]), (None, [1.0] * 6)]
    got = nearest(vectors(spark, rows + odd), k=20)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def test_relaxed_search_keeps_recall(spark):
    draw = np.random.default_rng(4)
    rows = [(k, v.tolist()) for k, v in enumerate(draw.normal(size=(40, 8))[draw.integers(0, 40, 3000)] + 0.2 * draw.normal(size=(3000, 8)))]
    got = {(r["query_id"], r["vec_id"]) for r in nearest(vectors(spark, rows), k=10, factor=1.5).collect()}
    wanted = {(q, i) for q, _, i, _ in brute(rows, 10)}
    assert len(got & wanted) >= 0.9 * len(wanted)


def test_few_vectors(spark):
    assert nearest(vectors(spark, []), k=3).count() == 0
    assert nearest(vectors(spark, [(0, [1.0, 2.0])]), k=3).count() == 0
    got = nearest(vectors(spark, [(0, [1.0, 2.0]), (7, [1.0, 0.0]), (5, [1.0, 0.0])]), k=20).collect()
    assert [tuple(r) for r in got] == [(0, 1, 5, 1.0), (0, 2, 7, 1.0)]


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>"</script></head><body>
<header>Site</header><nav><ul><li><a href="/x">Menu</a></ul></nav><div class="cookie-banner">We use<p>cookies</div>
<article><header><h1>The &amp; title</h1></header><p>One <b>bold</b>&nbsp;word<br>and &lt;more&gt;<p title="a > b">Two<!-- <p>no</p> -->
<ul><li>first<li>second</ul><aside>See also</aside><form>Mail <input> <button>Go</button></form><pre>x
 y</pre><div id='comments'><p>Nice!</div><table><tr><td>a<td>b</table></article><aside>Side</aside><div class="ad">Buy</div><footer>&copy; us</footer>"""


def test_markup():
    page = read_page(PAGE)
    assert page.article == ["The & title", "One bold word and <more>", "Two", "first", "second", "x y", "a", "b"]
    assert read_page("").article == [] and read_page("<article><p>a < b & c").article == ["a < b & c"]
    assert read_page("plain <i>text</i>").open == ["plain text"]
    assert read_page("<main><p>in</main><p>out").article == ["in"]


def test_repeats_of_a_host_are_boilerplate(spark):
    notice = "all rights of this fine site are kept by us"
    page = "<body><div>Welcome to the great site of nice things</div><p>{}</p><p>{}</p></body>"
    rows = [(k, f"https://{'h' if k < 5 else f'other{k}'}.example/{k}", page.format(prose(k, 30), notice)) for k in range(8)]
    rows += [(8, "https://h.example/a", f"<article><p>{notice}</p></article><p>{notice}</p>")]
    rows += [(9, "https://h.example/b", None), (10, None, page.format("x", "y")), (10, None, page.format("x", "y")), (None, "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({n: F.lit(1) for n in ("page", "host", "text", "starts")})
    got = {r["page_id"]: r for r in main_text(df).collect()}
    for k in range(5):
        assert got[k]["text"] == prose(k, 30)
    for k in range(5, 8):
        assert got[k]["text"] == f"Welcome to the great site of nice things\n\n{prose(k, 30)}\n\n{notice}"
    assert got[8]["text"] == notice  # a passage of an article stays
    assert got[9]["text"] == got[None]["text"] == "" and got[10]["text"].endswith("x\n\ny")
    assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and main_text(df).count() == len(rows)
    assert main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        '<div class="site has-sidebar"><article>{}</article></div>',
        '<div id="page" class="menu-closed"><main>{}</main></div>',
        '<div class="sidebar"><article>{}</article></div><div class="sidebar">x</div>',
        '<div class="widget"><div class="menu"><main><article>{}</article></main></div></div><p>x</p>',
        '<article><section class="side-effects">{}</section><div class="related">x</div></article>',
        '<article><div class="article-header">{}</div></article><div class="related"><article>x</article></div>',
        '<article><div class="header">{}</div><div class="comments"><article>x</article></div></article>',
        '<article><div class="related-work" data-id="ad" data-grid=menu title="x id=ad">{}</div><p id=ad>y</p><div id=ad>x</div></article>',
    ],
)
def test_names_around_and_inside_articles(page):
    got = read_page(page.format("<h1>The title</h1><p>and text"))
    assert got.has_article and got.article[:2] == ["The title", "and text"] and "x" not in got.article


def test_noise_by_tag_still_holds_no_article():
    assert not read_page('<aside><article>x</article></aside><nav class="a"><main>y</main></nav>').has_article


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article><p>One <svg class="icon"/> two</p><p>three</p></article>', ["One two", "three"]),
        ('<article><p>One <math display="block"/> two</p><svg><path d="M0"/></svg><p>three</p></article>', ["One two", "three"]),
        ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p><p>so</p></article>", ["Let x=1 be", "so"]),
        ("<article><svg><svg><text>A</text><text>B</text></svg><text>C</text></svg><p>so</p></article>", ["A B C", "so"]),
        ("<article><svg><title/><style/><script/><style>p{}</style><title>icon</title></svg><p>so</p></article>", ["so"]),
        ("<article><svg><path><p>so</p><script>no()</script><p>on</p></article>", ["so", "on"]),
    ],
)
def test_formulas_and_drawings(page, text):
    assert read_page(page).article == text


def test_few_repeats_of_a_host_are_text(spark):
    footer, passage = "all rights of this fine site are kept by us", prose(90, 30) + " endword"
    page = "<body><div>{}</div><p>{}</p></body>"
    texts = [prose(k, 40) for k in range(20)]
    texts[1] = texts[0]  # one article at two addresses, with a line of its own
    texts[2:5] = [f"{t} {passage}" for t in texts[2:5]]  # a passage quoted by three of twenty
    rows = [(k, f"https://h.example/{k}", page.format(t + (" print" if k == 1 else ""), footer)) for k, t in enumerate(texts)]
    rows += [(100 + k, "https://few.example/" + "ab"[k], page.format(prose(50, 40), f"{footer} {k}")) for k in range(2)]
    rows += [(200 + k, f"https://same.example/{k}", page.format(prose(60, 40), footer)) for k in range(5)]  # one page, five addresses
    rows += [(300 + k, f"https://mix.example/{k}", f"<article>{prose(k, 9)}</article><p>{footer}</p>") for k in range(4)]
    rows += [(310, "https://mix.example/p", page.format(prose(70, 40), footer))]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(20)] == [t + (" print" if k == 1 else "") for k, t in enumerate(texts)]
    assert [got[100 + k] for k in range(2)] == [f"{prose(50, 40)}\n\n{footer} {k}" for k in range(2)]
    assert {got[200 + k] for k in range(5)} == {f"{prose(60, 40)}\n\n{footer}"}
    assert got[310] == prose(70, 40)  # outer blocks of pages with an article are evidence
