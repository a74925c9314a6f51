from vanewright.llm import html

ARTICLE = "<h1>A &amp; B</h1><p>One   two<br>three <b>bo</b>ld<p>Second &lt;x&gt; para &#233;</p><ul><li>item one</li><li>item two</li></ul>"
WANT = "A & B\nOne two three bold\nSecond <x> para é\nitem one\nitem two"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href=/x>menu</a></li></ul></nav>{body}<aside>side</aside><footer>foot</footer></body></html>"


def test_blocks():
    for body in (f"<article>{ARTICLE}</article>", f"<div class='post-12'>{ARTICLE}</div>", f"<article class='post has-comments'><header>site</header>{ARTICLE}</article>", f"<main><section>{ARTICLE}<div class='comments'><p>{'reader ' * 80}</p></div></section></main>", f"<div id=content>{ARTICLE}<div class='ad'>buy</div><form><p>f</p></form><!-- <p>no</p> --><script>var a='</p>';</script></div>"):
        assert html.Page(page(body)).extract(None) == WANT, body


def test_odd_pages():
    for source, want in (("", ""), ("plain", "plain"), ("<", "<"), ("<p", ""), ("<article><p>cut in the", "cut in the"), ("<script>x", ""), ("<a" * 5000, ""), ("<p>" * 5000, ""), ("<div>" * 3000 + "deep", "deep"), ("<p>1 < 2 &amp; 3</p>", "1 < 2 & 3"), ('<p title="a>b">x</p>', "x"), ("<p class='x>y</p><p>z</p>", "y\nz")):
        assert html.Page(source).extract(None) == want, source


def test_what_belongs_to_the_article():
    fill = "<p>" + "filler words " * 20 + "</p>"
    cases = {
        '<div data-note="not hidden here"><p>kept</p></div>': "kept", "<p class='share-price'>kept</p>": "kept", "<p id=reply-to>kept</p>": "kept", '<h2 class="section-header">kept</h2>': "kept",
        "<p>A <button>Go</button> B</p>": "A B", "<p>A\u2003\u2003B\u3000C&nbsp;&#x2003;D</p>": "A B C D", "<header><h1>Title</h1><nav>menu</nav></header>": "Title", "<p>x <math><mi>y</mi></math> z</p>": "x y z",
        "<p>a <span hidden>gone <span>too</span></span>b</p>": "a b", "<div class='cookie-banner'>gone</div>": "", "<div class='ad-slot 3'>gone</div>": "", "<div id='site-header'>gone</div>": "", "<div class='post-comments'><p>gone</p></div>": "",
        "<form><p>gone</p></form>": "", "<div style='display: none'>gone</div>": "", "<div role=banner>gone</div>": "", "<p>1</p><!-- no --><p title='a > b'>2</p>": "1\n2", "<pre>a\n  b</pre>": "a b", "<ul><li>one<li>two</ul>": "one\ntwo",
        "<table><tr><td>c1<td>c2</table>": "c1\nc2", "<p>5 &lt; 6 &AMP; &notit; &#128512;</p>": "5 < 6 & ¬it; 😀", "<noscript>gone</noscript><p>k</p>": "k",
    }
    for body, want in cases.items():
        got = html.Page(page(f"<article>{fill}{body}{fill}</article>")).extract(None).split("\n")
        assert "\n".join(got[1:-1]) == want, body


def test_wrappers_with_marking_names_keep_the_article():
    article = f"<article>{ARTICLE}</article>"
    long = "<div class='comments'><article><p>" + "reader " * 200 + "</p></article></div>"
    cases = [
        f"<form id='aspnetForm'><nav>menu</nav>{article}<input name=q><div class='sidebar'>side</div></form>", f"<div class='container sidebar-right'>{article}</div>", f"<div id='header-main'>{article}</div>",
        f"<div class='widget main-content'>{article}</div>", f"<main><header>{ARTICLE.split('</h1>')[0]}</h1><nav>menu</nav></header>{ARTICLE.split('</h1>')[1]}</main>",
        f"<form id='aspnetForm'><header>site</header><div class='content'>{ARTICLE.replace('h1', 'h2')}</div><form><p>search</p></form></form>", f"<form><div class='widget'>{article}{long}</div></form>",
        f"<div class='content'>{article}{long}</div>", f"<div class='container sidebar-left'><div class='post'>{ARTICLE}</div><div class='sidebar'>side</div></div>",
    ]
    for body in cases:
        assert html.Page(page(body)).extract(None) == WANT, body
    for body in ("<div class='cookie-banner'><p>only a notice</p></div>", "<form><p>Name</p><p>Send</p></form>", "<div class='comments'><p>only comments</p></div>", "<form role=search><h1>Search</h1></form>"):
        assert html.Page(page(body)).extract(None) == "", body


def test_deep_pages_take_linear_memory():
    import tracemalloc

    tracemalloc.start()
    assert html.Page("<div class='a b'>" * 100_000 + "deep").extract(None) == "deep"
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    assert html.Page("<div>" * 20_000 + "x" + "</span></p>" * 20_000).extract(None) == "x"


def test_consensus(spark):
    short = "<div class='lead'><p>" + "teaser words " * 30 + "</p></div><div class='text'><p>tiny</p></div>"
    long = "<div class='lead'><p>teaser</p></div><div class='text'><p>" + "real words " * 40 + "</p></div>"
    rows = [(k, f"http://a.example/{k}", page(long)) for k in range(5)] + [(5, "HTTP://A.example:80/q", page(short)), (6, None, None), (7, "no url", ""), (8, "http://b.example/", page("<article><p>only</p></article>")), (8, "http://b.example/", page("<article><p>only</p></article>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' as path", "'clash' as text", "'clash' as host")
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in html.op9(df).collect()]
    by = {g[0]: g[1] for g in got}
    assert by[5] == "tiny" and by[0] == ("real words " * 40).strip() and by[6] == by[7] == "" and by[8] == "only" and len(got) == len(rows)
    assert all(n == len(t) for _, t, n in got)
    assert html.op9(df.where("false")).count() == 0


def test_pages(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    rows = html.op9(df).join(df.select("page_id", "html"), "page_id").collect()
    import html as lib
    import re

    for r in rows:
        inner = re.split(r"</article>", r["html"].split("<article>", 1)[1])[0]
        blocks = [re.sub(r"\s+", " ", lib.unescape(re.sub(r"<br>|</?b>", lambda m: " " if m[0] == "<br>" else "", x))).strip() for x in re.split(r"</?(?:p|h1|ul|li|div)[^>]*>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b)
