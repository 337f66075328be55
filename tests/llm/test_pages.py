import html
import re
import time

import pytest
from pyspark.sql import functions as F

from starload.llm.html_blocks import blocks, features
from starload.llm.html_labels import PAGES
from starload.llm.html_text import extract, judge, labelled, main_text, train
from starload.llm.url_filter import BAD, host_and_path, judge as judge_urls, longest_rule, mine, tokens
from starload.llm.page_plans import RULES, labelled_urls


@pytest.fixture(scope="module")
def tree(spark):
    return train(spark)


def test_blocks_of_bad_markup():
    text = lambda page: [b.text for b in blocks(page)]
    assert text("") == [] and text("<p") == [] and text("a &amp; b &lt;c&gt; &nbsp; d &am") == ["a & b <c> d &am"]
    assert text('<p><b>one<br><p>two <i>t</i>hree</p><!-- no --><script>var t="</p>";</script>four') == ["one", "two three", "four"]
    assert text("<title>no</title><style>p{}</style><p title='a>b'>yes <a href=x>link</a></p></div></section>") == ["yes link"]
    assert text("x < y and 1<2") == ["x < y and 1<2"] and text("<ul><li>a<li>b</ul>c") == ["a", "b", "c"]


_STORY = "<article><h1>Title</h1><p>Short.</p><p>A second one with some more words in it.</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        f'<body class="has-sidebar">{_STORY}</body>',
        f'<html class="no-search"><body class="header-fixed comments-open">{_STORY}</body></html>',
        f'<div id="page" class="header-fixed">{_STORY}<div class="related"><article><p>A card on another story, with a number of words in it.</p></article></div></div>',
        f'<div class="post-with-comments">{_STORY}<div class="comments"><p>First! What a fine story this was to read in the train today.</p></div></div>',
        f'<div class="social-wrap"><div class="menu-open">{_STORY}</div></div>',
        f'<div class="hidden md:block" title="not hidden here">{_STORY}</div>',
        f'{_STORY}<div class="sidebar"><article><p>A card on another story, with a number of words in it.</p></article></div>',
        f'{_STORY}<div hidden><article><p>A part that no reader sees, with a number of words in it.</p></article></div>',
    ],
)
def test_wrappers_are_no_side_parts(tree, page):
    assert main_text(tree, page) == "Title Short. A second one with some more words in it."
    assert [b.text for b in blocks(page) if b.main and not b.aside] == ["Title", "Short.", "A second one with some more words in it."]


def test_state_words_in_classes(tree):
    text = "In a plain page without any article element, this text has a number of words that a menu has not, and so it is kept."
    assert main_text(tree, f'<div class="post-with-comments"><p>{text}</p><p>{text}</p></div>') == f"{text} {text}"
    assert all(b.aside for b in blocks(f'<div class="post-comments"><p>{text}</p></div><p style="display:none">{text}</p>'))


def test_only_scripts_styles_and_forms_are_dropped():
    text = lambda page: [b.text for b in blocks(page)]
    assert text("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> and <object>a fallback</object> on</p>") == ["so x=1 and a fallback on"]
    assert text("<noscript><p>one</p></noscript><xmp>two</xmp><video>three</video>") == ["one", "two", "three"]
    assert text("<p>a <svg><path d='x'> b</p><p>c</p>") == ["a b", "c"] and text("<object><p>d</p>") == ["d"]
    assert text("<iframe src=x><p>e</p><textarea><p>f</p>") == ["e", "f"] and text("<p>g</p><script>h <p>i</p>") == ["g"]
    assert text("<select><option>j</select><template><p>k</p></template><svg><style>l{}</style></svg>m") == ["m"]


def test_tree_learns_its_labels(spark, tree):
    rows = labelled(spark, PAGES).collect()
    assert len(rows) > 200
    assert sum(judge(tree, r.features.toArray()) == (r.label > 0.5) for r in rows) >= 0.97 * len(rows)


def test_pages_of_other_making(tree):
    cases = [
        ('<body><div id="cookie-banner"><p>We use cookies, as all do, to see who reads our many pages here.</p></div><article><h1>Title</h1><p>Short.</p><p>A second one with some more words in it.</p></article><section class="comments"><p>First! What a fine story this was to read in the train today.</p></section></body>', "Title Short. A second one with some more words in it."),
        ('<header><p>The Paper</p></header><main><p>Only text.</p><aside>Also read this long text about the other thing that came to pass last week.</aside><p>End.</p></main><form><p>Your name and your address please, so that we can write to you.</p></form>', "Only text. End."),
        ('<nav><a href="/">Home</a></nav><p>In a plain page without any main part, this text has a number of words that a menu has not, and so it is kept.</p><p>The next one of them goes on in the same way for a while and then it ends as well, at last.</p><footer>All rights kept by those who made this page.</footer>', "In a plain page without any main part, this text has a number of words that a menu has not, and so it is kept. The next one of them goes on in the same way for a while and then it ends as well, at last."),
        ('<div class="topNav"><a href=a>One</a></div><div class="page-header"><p>The name of this page and a line on what it is about for those who come here first.</p></div><div id="content"><p>Kept.</p><div style="display: none">Not seen by any reader of this page at all.</div><p hidden>Nor this one.</p><div class="user-comments"><p>I like it.</p></div></div>', "Kept."),
    ]
    for page, want in cases:
        assert main_text(tree, page) == want


def test_articles_of_the_given_pages(spark, tree):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(pages, tree).collect()}
    for r in pages.collect():
        m = re.search("<article>(.*?)(</article>|$)", r.html, re.S)
        body = re.sub(r"<[^>]*(>|$)", " ", re.sub(r"</?(b|a)\b[^>]*>", "", m[1]))
        want = " ".join(html.unescape(body).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


PAGE = "page_id long, url string, html string, text string, n_chars string"


def test_odd_pages(spark, tree):
    long = "<article><p>" + "word and word " * 200_000 + "</p></article>"
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<article><p>Hi.</p></article>"), (2, "v", "<html></html>"), (3, "w", long)]
    got = extract(spark.createDataFrame([(*r, "x", "y") for r in rows], PAGE), tree).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in got] == [(1, "u", 0), (1, "u", 0), (None, None, 3), (2, "v", 0), (3, "w", 14 * 200_000 - 1)]
    assert [r.text for r in got[:4]] == ["", "", "Hi.", ""]
    assert extract(spark.createDataFrame([], PAGE), tree).count() == 0


def test_features_see_neighbours():
    x = features(blocks("<p>a b c</p><p><a href=x>d e</a> f g</p>"))
    assert x[0, 4:].tolist() == [3, 0, 0, 0, 4, 0.5] and x[1, 4:].tolist() == [4, 0.5, 3, 0, 0, 0]


URLS = [
    ("https://A.Example.NET/en/1", "a.example.net", "/en/1", "example.net/en/"),
    ("http://example.net/fr/1?x=/en/", "example.net", "/fr/1", "net/"),
    ("http://badexample.net", "badexample.net", "", None),
    ("x://sub.ÄB.org/fr/#a", "sub.Äb.org", "/fr/", "org/fr/"),
    ("http://example.com/de/a", "example.com", "/de/a", "example.com/de/"),
    ("http://notexample.com/de/a", "notexample.com", "/de/a", None),
    ("http://h?q/de/", "h", "", None),
    ("no scheme", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
    ("a://b://c/d", "b:", "//c/d", None),
]


def test_hosts_paths_and_rules(spark):
    rows = spark.createDataFrame([(i, u[0], "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, verdict string, host string")
    nothing = mine(spark.createDataFrame([], "url string, bad boolean"))
    got = sorted(judge_urls(rows, RULES, nothing).collect())
    verdict = {f"{h}{p}": v for v, h, p in RULES}
    assert [tuple(r) for r in got] == [(i, h, p, r, verdict.get(r, "allow")) for i, (_, h, p, r) in enumerate(URLS)]
    assert judge_urls(rows.limit(0), RULES, nothing).count() == 0
    assert spark.range(1).select(F.lit("a").alias("host"), F.lit("/").alias("path")).select(longest_rule([])).first()[0] is None


def _token_sets(rows):
    host, path = host_and_path()
    held = rows.where("url is not null and bad is not null").select("url", host.alias("host"), path.alias("path"), "bad")
    return [(frozenset(r.t), r.bad) for r in held.select(tokens().alias("t"), "bad").collect()]


def test_mined_rules_against_brute_force(spark):
    """Every token and pair of tokens that implies the bad label often enough is a rule, if no token of it is one; of tokens on the same
    URLs the least stands for all."""
    good = [(f"https://news{i % 7}.site.org/en/{i}?ref=x", False) for i in range(60)] + [(f"https://pills.site.org/en/{i}", False) for i in range(20)]
    good += [(f"https://a{i}.shop.com/en/{i}", False) for i in range(9)]
    bad = [(f"http://pills.shop.com/buy/{i}", True) for i in range(20)] + [("http://pills.shop.com/buy/1", True)] * 5
    bad += [(f"http://cheap-{i % 3}.site.org/en/x?ref=x", True) for i in range(22)]
    labelled_rows = spark.createDataFrame(good + bad + [(None, True), ("http://x", None)], "url string, bad boolean")
    rules = mine(labelled_rows, 0.05, 0.9)
    found = {frozenset(r.antecedent) for r in rules.collect()}
    sets = _token_sets(labelled_rows)
    on = {t: frozenset(i for i, (s, _) in enumerate(sets) if t in s) for s, _ in sets for t in s}
    names = {min(t for t in on if on[t] == rows) for rows in on.values()}
    good_rule = lambda rows: (h := sum(sets[i][1] for i in rows)) >= max(20, 0.05 * len(sets)) and h >= 0.9 * len(rows)
    want = {frozenset([t]) for t in names if good_rule(on[t])}
    want |= {frozenset([a, b]) for a in names for b in names if a < b and not {frozenset([a]), frozenset([b])} & want and good_rule(on[a] & on[b])}
    assert {f for f in found if len(f) <= 2} == want and any(len(f) == 2 for f in want)
    assert not any(BAD in f for f in found) and not any(a < b for a in found for b in found)
    pages = [(i, u) for i, u in enumerate(["http://pills.shop.com/buy/777", "https://pills.site.org/en/5", "http://pills.shop.com/buy/777", "http://other.com/sell/1", None])]
    got = {r.page_id: r.verdict for r in judge_urls(spark.createDataFrame(pages, "page_id long, url string"), [("allow", "shop.com", "/x")], rules).collect()}
    assert got[0] == got[2] == "block" and got[1] == got[4] == got[3] == "allow"


def test_no_rule_rests_on_few_urls_and_long_queries_do_not_explode(spark):
    params = "&".join(f"p{i}=v{i}" for i in range(40))
    few = [(f"http://h{i}.com/a/{i}", i % 2 == 0) for i in range(100)] + [(f"http://spam.com/b?{params}", True)]
    assert mine(spark.createDataFrame(few, "url string, bad boolean")).count() == 0
    less = lambda i: "&".join(f"p{k}=v{k}" for k in range(40) if k != i)
    many = few + [(f"http://s{i}.spam.com/b?{less(i)}", True) for i in range(40)] + [(f"http://t{i}.spam.com/c?{params}", True) for i in range(30)]
    rules = mine(spark.createDataFrame(many, "url string, bad boolean")).collect()
    assert 0 < len(rules) < 200 and all(r.support * len(many) >= 20 for r in rules)
    # what only two tokens together tell is found
    pair = [(f"http://x.net/a/n{i}", False) for i in range(60)] + [(f"http://y.net/b/n{i}", False) for i in range(60)] + [(f"http://x.net/b/n{i}", True) for i in range(30)]
    assert {frozenset(r.antecedent) for r in mine(spark.createDataFrame(pair, "url string, bad boolean")).collect()} == {frozenset({"host=x", "path=b"})}


def test_labelled_urls_join_by_number(spark):
    pages = spark.createDataFrame([("http://h/en/12?page=2",), ("http://h/en/13.html#a",), ("http://h/14/",), ("http://h/en/x",), (None,)], "url string")
    labels = spark.createDataFrame([(12, 0, 0), (13, 1, 0), (14, 1, 1), (14, 1, None)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, labelled_urls(pages, labels).collect())) == [("http://h/14/", True), ("http://h/en/12?page=2", True), ("http://h/en/13.html#a", False)]


@pytest.mark.parametrize("page", ["<div>" * 50_000, "<div>" + "</p></section>" * 50_000, "<p>" + "<span>" * 50_000, "<div class=sidebar><article>" * 20_000])
def test_broken_markup_takes_time_in_proportion(page):
    """Unclosed and stray tags: eight times the page may take a small multiple of eight times the time, not 64 times."""

    def seconds(text):
        begun = time.process_time()
        blocks(text + "end")
        return time.process_time() - begun

    small = page[: len(page) // 8]
    assert seconds(page) < 24 * max(seconds(small), 0.02)


def test_rules_of_urls_with_many_tokens(spark):
    url = lambda *names: "http://a.b/?" + "&".join(names)
    decoys = [f"d{i:02d}" for i in range(14)]  # each mostly on bad URLs, more so than x and y
    bad = [(url("x", "y", *(d for k, d in enumerate(decoys) if k != i % 14)), True) for i in range(42)]
    good = [(url(t), False) for t in ("x", "y") for _ in range(30)] + [(url(d), False) for d in decoys for _ in range(15)]
    labelled = spark.createDataFrame(bad + good, "url string, bad boolean")
    found = {frozenset(r.antecedent): r.confidence for r in mine(labelled).collect()}
    assert found[frozenset({"query=x", "query=y"})] == 1.0
    assert len(found) == 16 * 15 // 2 and all(len(r) == 2 for r in found)  # any two tokens are on bad URLs only
