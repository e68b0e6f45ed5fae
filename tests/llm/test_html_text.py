import html
import re

from tarnbeck.llm import html_text as H
from tarnbeck.llm import queries


def test_pages():
    cases = {
        "": "",
        "just text": "just text",
        "<p>a < b &lt;i&gt; &amp; c &copy": "a < b <i> & c ©",
        "<html><body><nav><a>x</a></nav><article><h1>T</h1><p><b>One\n two<br>three<p>Four</article><footer>f</footer>": "T\nOne two three\nFour",
        '<div class="menu"><a>Home</a></div><div id=content><p>A long sentence of the story.</p><div class=\'ad\'>Buy</div><p>More of it.</p></div><div class="comments"><p>me first</p></div>': "A long sentence of the story.\nMore of it.",
        "<article><header><h1>T</h1></header><aside>no</aside><p>b<script>var a='<p>x</p>'</script>c</p><form><p>sign</p></form><section class=\"comments\"><article class=comment><p>c</p></article></section></article>": "T\nb c",
        '<div class="ad">open<article><p>x</p></article>': "x",
        "<p>one</p><!-- <p>two</p> --><style>p{}</style><p>three</p>": "one\nthree",
        "<article><p>a</p><div class=cookie-notice><div>n</div>n</div><p>b</p></article><p>out</p>": "a\nb",
        "<p class=gladiator>shadow header</p>": "shadow header",
        "<article><p>x</p><p hidden>y</p><ul><li>l1<li>l2</ul></article": "x\nl1\nl2",
        "<p>cut <b": "cut",
    }
    for page, want in cases.items():
        assert H.main_text(page) == want, page


def test_short_blocks_without_article():
    long, short = ["x" * 600] * 3, "y" * 100
    paragraphs = "".join(f"<p>{x}</p>" for x in long)
    want = "\n".join([*long, short])
    for between in ("<div class=ad>Buy</div>", "<form>sign</form>", "<aside>no</aside>"):
        assert H.main_text(f"<body>{paragraphs}{between}<p>{short}</p></body>") == want
        assert H.main_text(f"<div><div>{paragraphs}</div>{between}<div><p>{short}</p></div></div>") == want
        assert H.main_text(f"<p>{short}</p>{between}{paragraphs}") == "\n".join([short, *long])
        assert H.main_text(f"{paragraphs}{between}<p><a>z</a></p><p>{short}</p>{between}{paragraphs}") == "\n".join([*long, "z", short, *long])
    home = "<ul><li><a>Home</a></ul><p><a>Up</a> &nbsp;| <a>Down</a></p>"
    assert H.main_text(f"{home}{paragraphs}<div class=ad>Buy</div><p>* * *</p><p>{short}</p>{home}") == "\n".join([*long, "* * *", short])
    assert H.main_text(f"{home}") == "" and H.main_text("<a name=top><p>one</p>") == "one"


def test_links_inside_article():
    links = [f"l{i}" for i in range(6)]
    listed = "<ul>" + "".join(f"<li><a href=/{x}>{x}</a>" for x in links) + "</ul>"
    nav = "<nav><a href=/>Home</a></nav>"
    for tag in ("article", "main"):
        for ad in ("", "<div class=ad>Buy</div>"):
            assert H.main_text(f"{nav}<{tag}><p>text</p>{ad}{listed}</{tag}>{nav}") == "\n".join(["text", *links])
            assert H.main_text(f"{nav}<{tag}>{listed}{ad}<p>text</p></{tag}>{nav}") == "\n".join([*links, "text"])
        assert H.main_text(f"{nav}<{tag}>{listed}</{tag}>{nav}") == "\n".join(links)
        assert H.main_text(f"<p>story</p><div class=ad>Buy</div><{tag}>{listed}</{tag}>") == "\n".join(["story", *links])


def test_marks():
    kept = [
        "article class='post has-sidebar'", "main class='with-sidebar'", "article class='promo'", "main id=search", "article class='post no-comments'", "h2 id='related-work'", "h2 id='search-algorithms'",
        "h3 id=comments", "p id='notice-1'", "section id='related-work'", "div id='search-algorithms'", "span id=Related_work", "a href='/hidden/page'", "a href=/hidden/page", "p title='Hidden gems'",
        "div class='overflow-hidden rounded'", "div class='content-sidebar-wrap'", "div class='layout--sidebar-left'", "div class=comments-open", "p data-id=nav", "p data-role='x' data-class='ad'", "p class=is-hidden id=x",
    ]
    left = [
        "article class=comment", "article class='hentry comment-body'", "article hidden", "div class=ad", "div id=cookie-notice", "div id='comment-12'", "div id='related-posts'", "section id=comments", "h2 class=widget",
        "div class='site-footer wide'", "div role=navigation", "p HIDDEN", "p class='x hidden'", "div aria-hidden=true", "div style='color:red; display : none'", "p hidden=''",
    ]
    for own in kept:
        assert H.main_text(f"<article><p>one</p><{own}>two</{own.split()[0]}></article>") == "one\ntwo", own
    for own in left:
        assert H.main_text(f"<p>one</p><{own}>two</{own.split()[0]}><p>three</p>") == "one\nthree", own
    assert H.main_text("<main class='with-sidebar'><p>a</p><h2 id=related-work>B</h2><p><a href='/hidden/page'>c</a></p></main>") == "a\nB\nc"
    assert H.main_text("<div class=related><article class=related-post><p>no</p></article></div><article><p>yes</p></article>") == "yes"


def test_long_page():
    page = "<article>" + "<p>word word</p>" * 50_000 + "</article>"
    assert H.main_text(page) == "\n".join(["word word"] * 50_000)


def brute(page):
    """For pages whose text is one article element of h1, p, b and br."""
    art = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x)))).strip() for x in re.split(r"</?(?:p|h1)>", art[1])]
    return "\n".join(b for b in blocks if b)


def test_query(spark, sf_dir):
    want = {r["page_id"]: (r["url"], brute(r["html"])) for r in queries.table(spark, sf_dir, "pages").collect()}
    got = queries.op7_html_text(spark, sf_dir).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)


def test_table_edges(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>x"), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    assert sorted(map(str, map(tuple, H.extract_text(df).collect()))) == sorted(map(str, [(1, "u", "", 0), (1, "u", "", 0), (None, None, "x", 1), (2, "v", "", 0)]))
    assert H.extract_text(df.where("false")).count() == 0


def test_article_keeps_link_blocks_and_wrappers_say_nothing():
    assert H.main_text("<article><p>Hello world text</p><p><a>Read the source</a></p></article>") == "Hello world text\nRead the source"
    for own in ("div class='layout has-sidebar'", "div class='post no-comments'", "article class='post-with-sidebar'", "div class='notice-of-death'", "section id='search-engine-history'"):
        assert H.main_text(f"<{own}><p>abc</p></{own.split()[0]}>") == "abc", own


def test_wrappers_that_hold_nearly_all_text_stay():
    story = "<p>a sentence of the story that is long</p>" * 12
    want = "\n".join(["a sentence of the story that is long"] * 12)
    for own in ("form id=aspnetForm", "div class=widget", "div id=sidebar"):
        assert H.main_text(f"<{own}><div class=ad>Buy</div>{story}</{own.split()[0]}>") == want, own
    assert H.main_text(f"<p>hi</p><div class=comments>{story}</div>") == "hi"
    assert H.main_text(f"<p>hi</p><footer>{story}</footer>") == "hi"


def test_distribution_decides_without_article():
    story = ["A sentence of the story, long enough to count for some."] * 4
    body = "".join(f"<div>{t}</div>" for t in story)
    links = "<div><a href=/>Home</a></div>" * 4
    # what is short and lies before the first surge or behind the last dive goes; between them all stays
    assert H.main_text(f"<div>Log in</div>{links}{body}{links}<div>Copyright</div>") == "\n".join(story)
    assert H.main_text(f"{body}{links}<div>ok.</div>{links}{body}") == "\n".join(story + ["Home"] * 4 + ["ok."] + ["Home"] * 4 + story)
    assert H.main_text(f"<div>Skip</div><header>h</header><h1>T</h1>{body}<footer>f</footer><div>imprint</div>") == "\n".join(["T", *story])
    assert H.main_text("<div>short</div>") == "short"


def test_unclosed_elements():
    assert H.main_text("<nav><ul><li><a>x</a><article><p>a<p>b<ul><li>c<li class=ad>d<li>e</ul></article>") == "a\nb\nc\ne"
    assert H.main_text("<table><tr><td>a<td>b<tr><td>c</table><p class=ad>x<p>d") == "a\nb\nc\nd"
    assert H.main_text("<p>one <span class=ad>buy <b>now</b></span>two</p>") == "one two"
    assert H.main_text("</div></p><p>a</article></div>b") == "a\nb"
