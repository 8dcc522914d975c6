import html as stdlib_html
import random
import re
import time

from tailframe.llm import html_text as ht
from tailframe.llm import url_filter as uf

PAGES = "page_id long, url string, html string, text string"


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randint(0, 14))] for _ in range(2))
        kept = sorted(ht.common_lines(a, b))
        it = iter(b)
        assert all(any(x == y for y in it) for x in (a[i] for i in kept)) and len(kept) == longest(a, b)


def test_long_alignments_end():
    a = [str(i % 50) for i in range(3000)]
    assert len(ht.common_lines(a, a[1:] + ["x"])) == 2999


def test_articles_of_all_pages(spark, sf_dir):
    def expected(page):
        inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        parts = re.split(r"</?(?:h1|p|li|ul|div)\b[^>]*(?:>|$)", inner)
        lines = [re.sub(r"\s+", " ", stdlib_html.unescape(re.sub(r"<[^>]*(>|$)", "", x.replace("<br>", " ")))).strip() for x in parts]
        return "\n".join(x for x in lines if x)

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in ht.extract_text(pages).collect()}
    for p in pages.collect():
        assert got[p.page_id].text == expected(p.html) and got[p.page_id].n_chars == len(expected(p.html)) and got[p.page_id].url == p.url


def texts(spark, rows):
    return {r.page_id: r.text for r in ht.extract_text(spark.createDataFrame([(*r, "clash") for r in rows], PAGES)).collect()}


def test_differencing_deletes_what_neighbours_share(spark):
    page = lambda own: f"<body><div>Site of wonders</div><div><p>{own} one</p><p>{own} two</p></div><div>Last words of the site</div></body>"
    rows = [(k, f"http://a.example/x/{k}", page(f"Page {k}'s paragraph that is long enough to stand alone, number")) for k in range(300)]
    for k, text in texts(spark, rows).items():
        lead = f"Page {k}'s paragraph that is long enough to stand alone, number"
        assert text == f"{lead} one\n{lead} two"


def test_copies_are_not_differenced(spark):
    page = "<body><p>One line here</p><p>Another line here</p></body>"
    assert set(texts(spark, [(1, "http://a/1", page), (2, "http://a/2", page), (2, "http://a/2", page)]).values()) == {"One line here\nAnother line here"}


def test_other_hosts_are_no_neighbours(spark):
    rows = [(1, "http://a/1", "<p>shared</p><p>own text of the first page</p>"), (2, "http://b/1", "<p>shared</p><p>own text of the second page</p>")]
    assert texts(spark, rows)[1] == "shared\nown text of the first page"


def test_markup_that_is_no_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header>Head</header><nav>Menu</nav>
    <script>if (a < b) { "</p>" }</script><main><div class="cookie-notice">Cookies!</div><article><header><h1>Title &amp; more</h1></header>
    <p>One <b>two<br>three</p><p>Four&nbsp;five<p>six <!-- <p>hidden --> seven<div id="advert-1">Buy</div><ul><li>a<li>b</ul>
    <form>Name <input></form><section class="comments"><p>First!</p></section><footer>by me</footer></article><aside>More</aside></main><footer>(c)</footer></body></html>"""
    assert ht.main_text(*ht.page_lines(page), []) [0] == "Title & more\nOne two three\nFour five\nsix seven\na\nb"


def alone(page):
    return ht.main_text(*ht.page_lines(page), [])[0]


def test_regions_forms_and_whole_names():
    assert alone("<main><h1>Story</h1><p>Long main text</p><article class='card'>Teaser</article></main>") == "Story\nLong main text\nTeaser"
    assert alone("<body><form><p>All of the page</p><p>is in a form</p></form></body>") == "All of the page\nis in a form"
    assert alone("<body><form><article><p>Text</p></article><p>x</p></form><form>Name <p>Mail</form></body>") == "Text"
    kept = "<article><p class='no-comment'>one</p><div class='social-science'>two</div><section class='related-work'>three</section></article>"
    assert alone(kept) == "one\ntwo\nthree"
    gone = ("site-footer", "cookie_banner", "commentList", "main-nav top", "related-posts", "x ad-slot-3", "reader-comments", "sidebar2")
    assert [alone(f"<article><p>text</p><div class='{c}'>gone</div></article>") for c in gone] == ["text"] * len(gone)
    assert alone("<p>One outside of the only article, which is long enough</p><article>Ad</article>") == "One outside of the only article, which is long enough\nAd"


def test_end_tags_without_a_start_take_no_time():
    page = "<div>" * 20_000 + "text" + "</p></b>" * 20_000
    began = time.time()
    assert alone(page) == "text" and time.time() - began < 5


def test_differencing_decides_before_markup(spark):
    """No class name says what the template's lines are, and every article has its own."""
    page = lambda k: f"<body><div>Site of wonders</div><div><h2>Story {k}</h2><p>Paragraph {k} of a text that is long enough to be one</p></div><div class='x9'>Read on</div></body>"
    rows = [(k, f"http://a.example/x/{k:04}", page(k)) for k in range(40)]
    got = ht.extract_text(spark.createDataFrame([(*r, "clash") for r in rows], PAGES), range_pages=8).collect()
    assert all(r.text == f"Story {r.page_id}\nParagraph {r.page_id} of a text that is long enough to be one" and r.n_shared == 2 for r in got) and len(got) == 40
    whole = ht.extract_text(spark.createDataFrame([(*r, "clash") for r in rows], PAGES)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, got))


def test_given_pages_have_template_lines_that_differencing_deletes(spark, sf_dir):
    assert ht.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).where("n_shared > 0").count() > 0


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "no url", ""), (3, "http://a", "plain &lt;text&gt;"), (None, "http://a", "<p>x</p"), (4, "http://b", "<article><p>cut off <a href='"), (5, "http://c", "<p>" + "word " * 100_000)]
    got = texts(spark, rows)
    assert (got[1], got[2], got[3], got[None], got[4]) == ("", "", "plain <text>", "x", "cut off") and len(got[5]) == 499_999
    assert texts(spark, []) == {}


# -- URLs ----------------------------------------------------------------------------------------------------------


def judged(spark, urls, rules=(), listed=(), **how):
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)], "page_id long, url string, host string")
    keys = spark.createDataFrame([(h,) for h in listed], "key string")
    return {r.page_id: r for r in uf.judge_urls(pages, list(rules), keys).collect()}


def test_hosts_and_paths(spark):
    urls = ["http://WWW.A.example:80/P/Q?x#y", None, "nothing", "://", "a://b?c/d", "x://h#/f", "http://é.ORG/ü?", "http://a\nb/c\nd"]
    got = judged(spark, urls)
    assert [(got[k].host, got[k].path) for k in range(len(urls))] == [("www.a.example:80", "/P/Q"), ("", ""), ("", ""), ("", ""), ("b", ""), ("h", ""), ("é.org", "/ü"), ("a\nb", "/c\nd")]


def test_longest_rule(spark):
    rules = [uf.UrlRule("allow", "org", "/"), uf.UrlRule("block", "example.org", "/es/"), uf.UrlRule("block", "example.org", "/en/1")]
    got = judged(spark, ["http://x.example.org/es/1", "http://example.org/en/10", "http://example.org/fr", "http://badexample.org/es/", "http://org/", "http://org"], rules)
    assert [(r.rule, r.verdict) for _, r in sorted(got.items())] == [("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), ("org/", "allow"), ("org/", "allow"), (None, "allow")]


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(30_000).selectExpr("concat('host', id, '.example') as key").union(spark.createDataFrame([(None,)], "key string"))
    listed = universe.where("key like '%7.example'").union(spark.createDataFrame([("elsewhere",), (None,)], "key string"))
    cascade = uf.build_cascade(universe.union(universe), listed)
    wrong = universe.where("key is not null").where(cascade.contains(universe["key"]) != universe["key"].like("%7.example"))
    assert wrong.count() == 0 and len(cascade.levels) > 1
    assert sum(level.n_bits for level in cascade.levels) < 16 * 3_001


def test_listed_parents_and_empty_inputs(spark):
    got = judged(spark, ["http://a.bad.example/", "http://bad.example/x", "http://notbad.example/", "http://good.example/"], listed=["bad.example", "bad.example"])
    assert [r.verdict for _, r in sorted(got.items())] == ["block", "block", "allow", "allow"]
    assert judged(spark, []) == {} and judged(spark, ["http://a/"])[0].verdict == "allow"


def test_menus_whose_links_differ_by_page_are_deleted(spark):
    def page(k):
        menu = "".join(f"<li><a href='/{k}-{i}'>Item {k}-{i}</a></li>" for i in range(3))
        return f"<body><div><ul>{menu}</ul></div><div><p>Page {k} says this in a long sentence of its own, with <a href='#'>a link {k}</a> in it</p><p>and {k} says that</p></div></body>"

    got = texts(spark, [(k, f"http://a.example/x/{k}", page(k)) for k in range(30)])
    assert all(text == f"Page {k} says this in a long sentence of its own, with a link {k} in it\nand {k} says that" for k, text in got.items())


def test_pages_of_links_only_are_kept(spark):
    rows = [(k, f"http://a.example/x/{k}", "<body><ul>" + "".join(f"<li><a href='/{k}-{i}'>Story {k}-{i}</a></li>" for i in range(3)) + "</ul></body>") for k in range(5)]
    assert all(text == "\n".join(f"Story {k}-{i}" for i in range(3)) for k, text in texts(spark, rows).items())


def test_share_of_template_lines_that_differencing_deletes_on_the_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    template = sum(not k & ht.ARTICLE for p in pages.collect() for k in ht.page_lines(p.html)[1])
    deleted = sum(r.n_shared for r in ht.extract_text(pages).collect())
    assert 0.3 * template < deleted < template  # many hosts have one page here, without neighbours
