"""Wrappers of hosts: what they find, and the extraction against counting in plain Python."""

import collections
import itertools
import time

import pytest

from starloom.llm.html_text import PRIOR, SHARE, Leaf, Node, extract, leaves, main_text, numbered, parse, simple_tree_matching, wrapper_tree
from tests.conftest import SMALL

PAGES = "page_id long, url string, html string"


def texts_of(spark, rows):
    return {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}


@pytest.mark.parametrize("entries", [16, 17, 30, 300])
def test_menus_of_any_length_are_template(spark, entries):
    menu = "".join(f"<li>entry {i}</li>" for i in range(entries))
    rows = [(i, "http://h.x", f"<body><ul class='zz'>{menu}</ul><div><p>own words {i}</p></div></body>") for i in range(40)]
    assert texts_of(spark, rows) == {i: f"own words {i}" for i in range(40)}


def test_copied_articles_are_no_template(spark):
    shell = "<body><div><p>welcome to the site</p></div><div><p>{}</p></div><div><p>all rights</p></div></body>"
    rows = [(i, f"http://h.x/{i}", shell.format(f"copied article {i % 10}" if i < 180 else f"unique article {i}")) for i in range(200)]
    got = texts_of(spark, rows)
    assert got[199] == "unique article 199" and got[3] == "copied article 3" and len(set(got.values())) == 30


def test_few_pages_prove_nothing(spark):
    page = "<body><div><p>same</p></div><p>other {}</p></body>"
    few, many = [[(i, "http://h.x", page.format(i)) for i in range(n)] for n in (2, 12)]
    assert texts_of(spark, few)[1] == "same other 1" and texts_of(spark, many)[1] == "other 1"


def test_repeated_template_and_equal_words_elsewhere(spark):
    rows = [(i, "http://h.x", f"<body><div>top</div><div>top</div><article><p>own {i}</p></article><div>end</div></body>") for i in range(20)]
    rows.append((99, "http://h.x", "<body><article><p>own 99</p><div>end</div></article></body>"))
    got = texts_of(spark, rows)
    assert got[4] == "own 4" and got[99] == "own 99 end"


def test_all_template_keeps_its_text(spark):
    rows = [(i, "http://h.x", f"<body><p>same</p>{'<p>own</p>' * (i > 0)}{i if i > 1 else ''}</body>") for i in range(30)]
    assert texts_of(spark, rows)[0] == "same"


def test_names_that_only_look_like_template():
    for name in ("share-price", "social-policy", "search-results", "ad-hoc"):
        assert main_text(f"<article><div class='{name}'>words</div>more</article>") == "words more"
    for name in ("share-buttons", "ad", "social_links", "comments-section", "related-items-3"):
        assert main_text(f"<article><div class='{name}'>words</div>more</article>") == "more"
    assert main_text("<body><div class='post-header'><h1>head</h1></div><p>text</p></body>") == "head text"
    assert main_text("<body><header class='entry-header'><h1>head</h1></header><p>text</p></body>") == "head text"
    assert main_text("<article>so <math><mi>x</mi></math> is</article>") == "so x is"
    assert main_text("<div>" * 70 + "<nav>menu</nav>deep") == "deep"


def test_pages_with_names_of_their_own_take_linear_time(spark):
    def seconds(n):
        rows = [(i, "http://h.x", f"<body id='s{'abcdefghij'[i % 10]}-{'x' * (i // 10)}'><div class='a{'y' * i}'>menu</div><p>own {i}</p></body>") for i in range(n)]
        start = time.monotonic()
        wrapper = wrapper_tree([("/body:1/div:1", numbered(parse(rows[0][2]))[0][1].label)])
        assert {main_text(r[2], wrapper) for r in rows} == {f"own {i}" for i in range(n)}
        return time.monotonic() - start

    seconds(100)
    assert seconds(800) < 12 * seconds(200) + 0.5


def test_tree_matching_equals_brute_force():
    def tree(spec, place=iter(range(10**6))):
        if isinstance(spec, int):
            return Leaf(spec, "", next(place))
        node = Node(spec[0])
        node.children = [tree(x) for x in spec[1:]]
        return node

    def best(a, b):
        if a.label != b.label:
            return 0
        if isinstance(a, Leaf):
            return 1
        n, m = len(a.children), len(b.children)
        ways = (zip(x, y) for k in range(min(n, m) + 1) for x in itertools.combinations(a.children, k) for y in itertools.combinations(b.children, k))
        return 1 + max(sum(best(x, y) for x, y in way) for way in ways)

    specs = [
        ("r", ("p", 1, 2), ("p", 3), 4), ("r", ("p", 3), ("p", 1, 2), 4), ("r", ("p", 1), 4, ("p", 2, 3)), ("r", 4, ("p", 1, 2), ("q", 3), 4),
        ("r", ("p", ("q", 1), ("q", 2)), ("p", ("q", 2)), 3), ("r", ("p", ("q", 2)), 3, 3), ("r",),
    ]
    for x, y in itertools.product(specs, specs):
        a, b = tree(x), tree(y)
        score, places = simple_tree_matching(a, b)
        assert score == best(a, b) and len(places) == len(set(places)) <= score


def test_extraction_equals_counting_in_python(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SMALL}/../sf0.01/pages.parquet").collect()]
    rows += [(10_000 + i, "http://h.x/", f"<body><ul><li>a<li>b</ul><div>{h}</div><p>end</p></body>") for i, (_, _, h) in enumerate(rows[:60])]
    hosts = collections.defaultdict(dict)

    def host(url):
        return url.split("//")[1].split("/")[0].split("?")[0].split(":")[0].lower()

    for _, url, html in rows:
        own = [(path, leaf.label) for path, leaf in numbered(parse(html))]
        hosts[host(url)][tuple(own)] = own
    wrappers = {}
    for name, pages in hosts.items():
        held, first, places = collections.Counter(), {}, collections.Counter()
        for own in pages.values():
            for place, (path, label) in enumerate(own):
                held[label] += 1
                places[label] += place
                first[label] = min(first.get(label, path), path)
        constant = sorted((places[x] / held[x], first[x], x) for x in held if held[x] >= SHARE * (len(pages) + PRIOR))
        wrappers[name] = wrapper_tree([(path, label) for _, path, label in constant])
    assert sum(1 for w in wrappers.values() if list(leaves(w))) > 0
    assert texts_of(spark, rows) == {i: main_text(html, wrappers[host(url)]) for i, url, html in rows}
