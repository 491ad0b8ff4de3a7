"""HTML extraction on pages with known main text."""

import html
import random
import re
import time

from afterglow.llm import html_extract as he

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style><script>var t="</p><article>no</article>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><!-- ad <p>x</p> -->
<div class="cookie-notice">We use cookies</div><aside class="sidebar"><p>Related</p></aside>
<article><h1>{title}</h1>{body}<div class="ad">Buy {title}</div><section id="comments"><p>Nice post {title}</p></section></article>
<form><label>Mail</label><input name="q"></form><footer>&copy; host</footer></body></html>"""


def body(blocks):
    out = []
    for i, b in enumerate(blocks):
        text = html.escape(b).replace("é", "&eacute;")
        out.append([f"<p>{text}</p>", f"<p>{text}\n ", f"<h2 id=x{i}>{text}</h2>", f"<ul><li>{text}</ul>", f"<p><b>{text[:0]}{text}</b><br>"][i % 5])
    return "".join(out)


def test_articles_of_one_host(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(60):
        blocks = [" ".join(rng.choice(["café", "a<b", "x&y", "word", "\"q\""]) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 12))]
        rows.append((i, f"http://h{i % 3}.example.com/{i}", PAGE.format(title=f"Title {i}", body=body(blocks)), "x"))
        want[i] = "\n".join([f"Title {i}", *blocks])
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(5)
    got = {r.page_id: r for r in he.extract(df).collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_pages_without_article_use_the_template(spark):
    make = lambda i: f"<body><div class=top>Welcome to the site</div><div><p>Story {i} one</p><p>two {i}</p></div><ul><li><a href=x>link {i}</a></li><li><a>more {i}</a></li></ul></body>"
    df = spark.createDataFrame([(i, "https://plain.example/", make(i)) for i in range(6)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in he.extract(df).collect()} == {i: f"Story {i} one\ntwo {i}" for i in range(6)}


def test_headers_main_elements_and_copies(spark):
    pages = [
        "<div class='site-header'><p>Site</p></div><article><header class='entry-header'><h1>Title</h1></header><p>text</p><div class='share-bar'>Share</div></article>",
        "<div id=top><p>Hello</p></div><div id='main-content'><p>one</p><aside>no</aside><p>two</p></div><div class=x>after</div>",
        "<p>copy of a page</p><div>second block</div>",
        "<main><p>main text</p><article class='comment'><p>reader</p></article></main>",
    ]
    rows = [(10 * i + k, f"http://host{i}.example/{k}", p) for i, p in enumerate(pages) for k in range(4)]
    got = {r.page_id: r.text for r in he.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = ["Title\ntext", "one\ntwo", "copy of a page\nsecond block", "main text"]
    assert got == {10 * i + k: want[i] for i in range(4) for k in range(4)}


def test_nulls_repeats_broken_and_empty(spark):
    rows = [(None, None, None), (1, None, ""), (2, "nonsense", "<p>text &amp; more <span hidden>no</span> end<"), (2, "nonsense", "<p>text &amp; more <span hidden>no</span> end<"), (3, "http://x/", "<article><p>a<br>b&nbsp;c<td>d</article>"), (4, "http://y/", "plain"), (5, "http://y/", "<article>" + "<p>x</p>" * 20000 + "</article>")]
    got = sorted(he.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect(), key=lambda r: r.page_id or 0)
    assert [r.text for r in got[:6]] == ["", "", "text & more end<", "text & more end<", "a b c\nd", "plain"]
    assert got[6].n_chars == 39_999
    assert he.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_wrapper_has_groups_options_and_slots():
    pages = ["<div><h2>A</h2><p>1</p><h2>B</h2><p>2</p></div><div class=x>same</div>", "<div><h2>C</h2><p>1</p></div><div class=x>same</div>", "<div><h2>A</h2><p>3</p></div><p>only here</p><div class=x>same</div>"]
    wrapper = []
    for i, page in enumerate(pages):
        nodes, _ = he.folded(he.fields(page))
        wrapper = he.generalised(wrapper, nodes) if i else nodes
    seen = [(n[he.PATH], n[he.TEXT], n[he.REPEATED], n[he.OPTIONAL]) for n in wrapper]
    assert seen == [("div/h2", None, True, False), ("div/p", None, True, False), ("p", "only here", False, True), ("div.x", "same", False, False)]


def test_agrees_with_a_plain_reading_of_generated_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|h2|h3|li|ul|div|blockquote)\b[^>]*>", inner)
        texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", b)).split()) for b in blocks]
        want[r.page_id] = "\n".join(t for t in texts if t)
    assert {r.page_id: r.text for r in he.extract(pages).collect()} == want


def test_values_are_not_read_as_attributes():
    for attributes in (' href="/news/hidden-lake"', ' title="hidden gems"', " href='/x?id=ads'", " href=/x?class=ads", " data-hidden", ' data-id="ads"'):
        names, hidden = he._marks(attributes)
        assert (".".join(names), bool(he.OUTSIDE_WORDS & set(names)), hidden) == ("", False, False)
    assert he._marks(' href="/a" ID = "Ads" hidden') == (["ads"], True)
    assert he._marks(" aria-hidden=true") == ([], True) and he._marks(" style='display: none'") == ([], True)
    assert [f.text for f in he.fields('<article><p title="hidden gems">Kept <a href="/x?id=ads">too</a></p></article>')] == ["Kept too"]


def test_the_wrapper_decides():
    """Without names that tell, the host's pages tell what is template, menu and text; a page alone does not."""
    make = lambda i: f"<div class=a><p>Read this house's long standing rules for guests before you go on, please</p></div><div class=b><p>Short text {i} that only this page has</p><p>its end {i}</p></div><div class=c><p>Written by the same people since 1990 in one place</p></div>"
    pages = [he.fields(make(i)) for i in range(5)]
    marks = he.judged(he.united([he.folded(p)[0] for p in pages]))
    assert [he.main_text(p, marks) for p in pages] == [f"Short text {i} that only this page has\nits end {i}" for i in range(5)]
    assert he.main_text(pages[0], []).count("\n") == 3  # all four blocks: with no wrapper nothing tells them apart


def test_the_wrapper_overrules_names():
    """An article in an element named like an advert is found by the text that the host's pages have there."""
    make = lambda i: f"<div class=promo><p>{'word ' * (40 + i)}{i}</p><p>more {i}</p></div><div class=main><p>x{i}</p></div>"
    pages = [he.fields(make(i)) for i in range(4)]
    marks = he.judged(he.united([he.folded(p)[0] for p in pages]))
    short = he.fields("<div class=promo><p>tiny</p><p>more 9</p></div><div class=main><p>xy</p></div>")
    assert he.main_text(short, marks) == "tiny\nmore 9" and he.main_text(short, []) == "xy"


def test_constants_inside_articles_go():
    make = lambda i: f"<article><h1>Title {i}</h1><p>Text {i} of this page, {'and so on ' * i}</p><div class=box><p>Follow us</p></div></article>"
    pages = [he.fields(make(i)) for i in range(4)]
    marks = he.judged(he.united([he.folded(p)[0] for p in pages]))
    assert all("Follow us" not in he.main_text(p, marks) for p in pages) and "Follow us" in he.main_text(pages[0], [])


def test_broken_markup_in_linear_time():
    for page in ("<a " * 350_000, '<a "' * 260_000, "<a href='" * 110_000, "<div>" * 100_000 + "x" + "</i></div>" * 100_000, "<span hidden>" + "<b>" * 100_000 + "</b>" * 100_000, "<!" * 500_000, "<script" * 150_000, "&#" + "9" * 1_000_000 + ";", "<fieldset>" * 50_000 + "<li>" * 50_000):
        began = time.perf_counter()
        found = he.fields(page)
        he.main_text(found, []) if found else ""
        assert time.perf_counter() - began < 3, page[:20]
    assert [f.text for f in he.fields("<p title=it's>don't <b x='>'>y</b> &#0000065;&#99999999;")] == ["don't y A\ufffd"]


def test_many_unlike_pages_of_a_host():
    def shapes(n):
        rng = random.Random(3)
        return [[he.Field(he.Path("p", f"p.x{rng.randint(0, 5000)}", None, frozenset()), f"t{rng.random()}", 0) for _ in range(40)] for _ in range(n)]

    def seconds(n):
        parts = [he.folded(p)[0] for p in shapes(n)]
        began = time.perf_counter()
        wrapper = he.united(parts)
        assert len(wrapper) <= 2 * he.WRAPPER_NODES
        return time.perf_counter() - began

    assert seconds(2000) < 8 * max(seconds(500), 0.2)


def test_alignment_is_a_common_subsequence():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abcdefghij") for _ in range(rng.randint(0, 12))] for _ in range(2))
        pairs = list(he.aligned(a, b))
        assert [i for i, _ in pairs if i is not None] == list(range(len(a))) and [j for _, j in pairs if j is not None] == list(range(len(b)))
        assert all(a[i] == b[j] for i, j in pairs if i is not None and j is not None)
        assert a != b or all(i == j for i, j in pairs)


def test_groups_fold_whatever_their_size():
    for size in (1, 2, 5, 9, 30):
        page = he.fields("<div>" + "".join(f"<p class={'x' * (k + 1)}>t</p>" for k in range(size)) * 4 + "</div><p>end</p>")
        nodes, node_of = he.folded(page)
        assert len(nodes) == size + 1 and all(n[he.REPEATED] for n in nodes[:-1]) and node_of == [*range(size)] * 4 + [size]


def test_hot_hosts_are_spread(spark, monkeypatch):
    """The join by host and salt gives what the broadcast gives."""
    from afterglow.llm import spread

    rows = [(i, f"http://h{i % 3 if i % 2 else 0}.example/{i}", f"<div class=t>Same words</div><div class=u><p>Own text {i}</p></div>") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {r.page_id: r.text for r in he.extract(df).collect()}
    monkeypatch.setattr(spread, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(spread, "HOT_SHARE", 6)
    got = he.extract(df)
    assert {r.page_id: r.text for r in got.collect()} == want == {i: f"Own text {i}" for i in range(60)}


def _unlike_pages():
    """840 pages of 4,200 places, each on four pages, and a template's box on three: more than a wrapper holds, and the box on the fewest."""
    name = lambda k: "q" + "".join(chr(97 + k // 26**e % 26) for e in range(3))
    rows, want = [], {}
    for i in range(840):
        texts = [f"own text {i} {k}" for k in range(20)]
        box = "<div class=box><p>Follow us</p></div>" if i in (5, 300, 777) else ""
        rows.append((i, "http://unlike.example/", f"<h1>Title {i}</h1>" + "".join(f"<p class={name(i % 210 * 20 + k)}>{t}</p>" for k, t in enumerate(texts)) + box))
        want[i] = "\n".join([f"Title {i}", *texts])
    return rows, want


def test_nodes_that_a_wrapper_loses_still_count(spark, monkeypatch):
    from afterglow.llm import spread

    rows, want = _unlike_pages()
    rows += [rows[5], (None, "http://unlike.example/", None), (900, "http://other.example/", "<p>alone</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    expected = sorted([*want.items(), (5, want[5]), (-1, ""), (900, "alone")])
    assert sorted((-1 if r.page_id is None else r.page_id, r.text) for r in he.extract(df).collect()) == expected
    monkeypatch.setattr(spread, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(spread, "HOT_SHARE", 50)
    assert sorted((-1 if r.page_id is None else r.page_id, r.text) for r in he.extract(df.repartition(7)).collect()) == expected


def test_long_gaps_are_aligned():
    """Lists in which nothing stands once are paired whatever their length."""
    for size in (20, 200):
        left, right = ["a", "b"] * size, ["x", "x", *["b", "a"] * size, "x", "x"]
        assert sum(i is not None and j is not None for i, j in he.aligned(left, right)) >= size
