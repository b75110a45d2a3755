"""Main text of pages."""
from tickscan.llm.html_text import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><a href=x>Home, sweet home, and so on and on</a></nav><div class="cookie-notice"><p>We use cookies, do you mind, please say so.</p></div>
<article><header><h1>A &amp; B</h1></header><p>First&nbsp;paragraph,   with <b>bold <i>words</b>, and
more.<br>Same block<p>Second one &lt;here&gt;, with &#8364; and &eacute;.<div class="ad">Buy, buy, buy this thing, please, now</div>
<ul><li>one</li><li>two</li></ul><blockquote>Quoted words</blockquote></article>
<aside><p>Side story, which nobody reads, but it is here, with commas, many.</p></aside>
<section id="comments"><p>Great article, I liked it, and so did my friends, really.</p></section>
<form><p>Your name, please, and your mail address, too</p></form><footer>Imprint</footer>"""


def test_article():
    assert main_text(PAGE) == ("A & B\nFirst paragraph, with bold words, and more. Same block\nSecond one <here>, with € and é.\none\ntwo\nQuoted words")


def test_container_without_article():
    html = ("<body><div id=top class=header>Site</div><div><h2>Title</h2><div class=post>" + "<p>A sentence, long enough to count, is here.</p>" * 3
            + "</div><div class='post-comments'><p>A comment, long enough to count, is here.</p></div></div><div class=footer>End</div>")
    assert main_text(html) == "Title\n" + "\n".join(["A sentence, long enough to count, is here."] * 3)


def test_links_of_the_article_stay():
    links = "<ul><li><a>one link</a></li><li><a>two links</a></li></ul>"
    html = "<main><p>Some text, with a comma, and enough words.</p>%s</main>"
    assert main_text(html % links) == "Some text, with a comma, and enough words.\none link\ntwo links"
    assert main_text(html % f"<nav>{links}</nav>") == main_text(html % f"<div class=menu>{links}</div>") == "Some text, with a comma, and enough words."
    table = "<table><tr><td><a>cell one</a></td><td><a>cell two</a></td></tr></table>"
    assert main_text(html % table).endswith("\ncell one\ncell two")
    assert main_text(html % "<div><p><a>A whole paragraph that is one link</a></p></div>").endswith("\nA whole paragraph that is one link")


P = "A sentence, long enough to count, is here."


def body(inner):
    return main_text(f"<html><head><title>T</title></head><body><div id=header><h1>Site</h1></div>{inner}<div id=footer>End of page</div></body></html>")


def test_heads_of_the_article():
    post = "<div class=post>" + f"<p>{P}</p>" * 3 + "</div>"
    want = "The title\n" + "\n".join([P] * 3)
    for head in ("<div class='post-header'><h1>The title</h1></div>", "<div class=entry-header><h2>The title</h2></div>", "<h1>The title</h1>",
                 "<hgroup><h1>The title</h1></hgroup>"):
        assert body(f"<div>{head}{post}</div>") == want
    assert body(f"<article><header><h1>The title</h1></header>{post}</article>") == want


def test_words_that_articles_are_about():
    long = "The share of the market, which had been small, grew by a third within the year, said the company."
    assert body(f"<article><p>{P}</p><section class='market-share'><h2>Shares</h2><p>{long}</p></section></article>") == f"{P}\nShares\n{long}"
    assert body(f"<article><p>{P}</p><div class='share'><a>Share this</a> <a>Mail this</a></div></article>") == P
    assert body(f"<article><p>{P}</p><div class='share-menu'><p>Tell others</p></div></article>") == P


def test_more_shapes():
    three = "\n".join([P] * 3)
    ps = f"<p>{P}</p>" * 3
    shapes = {
        f"<div class=content>{ps}<div class=related><p>{P} Read more, and more, and more of it.</p></div></div>": three,
        f"<main><div class=newsletter><p>{P}</p></div>{ps}</main>": three,
        f"<div role=main>{ps}</div><div role=complementary>{ps}</div>": three,
        f"<article>{ps}<pre>a = 1</pre><table><tr><th>k</th><td>v</td></tr></table></article>": three + "\na = 1\nk\nv",
        f"<article>{ps}<figure><img><figcaption>A caption</figcaption></figure></article>": three + "\nA caption",
        f"<article>{ps}<dl><dt>Term</dt><dd>Meaning</dd></dl></article>": three + "\nTerm\nMeaning",
        f"<article>{ps}<details><summary>More</summary><p>Hidden by choice only.</p></details></article>": three + "\nMore\nHidden by choice only.",
        f"<article>{ps}<div style='display: none'>Secret</div><button>Go</button><div hidden>x</div></article>": three,
        f"<table><tr><td><a>m1</a><br><a>m2</a></td><td>{ps}</td></tr></table>": three,
        f"<article><h1>T</h1>{ps}<section class=comments><p>{P}</p></section></article>": "T\n" + three,
        f"<article>{ps}<ol class=references><li><a>First source</a></li><li><a>Second source</a></li></ol></article>": three + "\nFirst source\nSecond source",
    }
    for html, want in shapes.items():
        assert body(html) == want, html


def test_broken_pages():
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == main_text("<script>x") == ""
    assert main_text("a < b <p") == "a < b"
    assert main_text("<article><p>cut &am") == "cut &am"
    assert main_text("<article><p>x<!-- open") == "x"
    assert main_text('<article><p title="a>b">x</p><p class="y>z</p>') .startswith("x")
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert main_text("<article>" + "<p>word</p>" * 20000 + "</article>").count("\n") == 19999


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 1), (None, None, None, 2), (1, "u", "", 3)], "page_id long, url string, html string, text int")
    out = sorted((tuple(r) for r in extract(pages).collect()), key=str)
    text = main_text(PAGE)
    assert out == sorted([(1, "u", text, len(text)), (None, None, "", 0), (1, "u", "", 0)], key=str)


def test_head_without_end_tag():
    assert main_text("<html><head><title>T</title><meta x><body><p>Some text, in the body.</p>") == "Some text, in the body."
    assert main_text("<head><title>T</title><link a><p>Some text, without a body tag.</p>") == "Some text, without a body tag."
    assert main_text("<head><title>T</title><style>p{}</style>Plain text") == "Plain text"


def test_wrappers_with_listed_words():
    p = "<p>A sentence, long enough to count, is here.</p>"
    kept = "Title\n" + "\n".join(["A sentence, long enough to count, is here."] * 4)
    side = "<div class=sidebar><p>A side story, long enough to count.</p></div>"
    for start, end in (("<div class='layout sidebar-right'>", "</div>"), ("<form action=x>", "</form>"),
                       ("<form><div id=menu-page>", "</div></form>")):
        assert main_text("<body>" + start + "<div><h1>Title</h1>" + p * 4 + "</div>" + side + end + "</body>") == kept
        assert main_text("<body>" + start + "<main><h2>Title</h2>" + p * 4 + "</main>" + side + end + "</body>") == kept
    comments = "<div id=comments>" + "<p>A comment, long enough to count, is here.</p>" * 30 + "</div>"
    assert main_text("<body><div><h1>Title</h1>" + p * 4 + "</div>" + comments) == kept


def test_empty_table(spark):
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
