import random

from wardloom.llm import htmltext

SCHEMA = "page_id long, url string, html string, text string, host string"


def text(source):
    found, blocks, inside, hashes, around = htmltext.parse_page(source)
    return found if found is not None else htmltext.without_template(blocks, inside, hashes, around, set())


def test_article_without_the_rest():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var x="</p><article>";</script></head><body><header>h</header><nav><ul><li>
    <a href="/a">menu</a></ul></nav><!-- <article>no</article> --><div class="ad">buy</div><article class=post><h1>Head &amp; more</h1><p>One  <b>two</b>
    &eacute;&#33;<p>Three<br>four<div class="share-box">share</div><blockquote>q</blockquote><ul><li>x<li>y</ul><form><p>mail</form>
    <section id="comments"><p>first!</section><table><tr><td>a<td>b</table></article><aside>side</aside><footer>&copy;</footer></body></html>"""
    assert text(page) == "Head & more\nOne two é!\nThree four\nq\nx\ny\na\nb"


def test_cut_and_broken_pages():
    for page, expected in [
        ("", ""), ("plain  text", "plain text"), ("<article><p>a &am", "a &am"), ("<article><p>a<p>b</ar", "a\nb"), ("<article><p>a</article><footer>f</foo", "a"),
        ("<article>1 < 2 & 3 <p>x</p>", "1 < 2 & 3\nx"), ('<article><p>a<a href="x>never', "a"), ("<p>a<!-- never", "a"), ("<script>never", ""),
        ("</p></div><article>a</span></article></b>", "a"), ("<article><p>a&nbsp; b</p></article>", "a b"), ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
        ("<article></article><p>outside</p>", ""), ("<p>only<div hidden>x</div>", "only\nx"), ("<article><p>a<nav>n</nav>b</article>", "a\nb"),
        ("<article><textarea>t</textarea><svg><p>s</svg><![CDATA[c]]></article>", "c"), ("<article>" + "<div>" * 3_000 + "deep", "deep"),
        ("<article><p>" + "w " * 200_000 + "</article>", ("w " * 200_000).strip()), ("\x00<article> a　b</article>", "a b"),
    ]:
        assert text(page) == expected, page[:60]


def test_odd_quotes_end_nothing():
    for page, expected in [
        ('<article><p>one</p><a href="x"">link</a><p>two</p></article>', "one\nlink\ntwo"), ('<article><p>one</p><img alt=5" src=x><p>two</p></article>', "one\ntwo"),
        ("<article><p don't>one</p><p>two</p></article>", "one\ntwo"), ("<article><p title='a>b'>one<p title=\"a>b\">two", "one\ntwo"),
        ("<article><p =x>one<p a==b>two<p a = 'x>y'>three<p a= >four<p/>five", "one\ntwo\nthree\nfour\nfive"), ("<article><p a='b'c=\"d\"e>one</p a=\">\">two", "one\ntwo"),
        ("<article><p title=it's>one<p>two", "one\ntwo"), ('<article><p>one<a href="x>never', "one"), ("<article><p>one<a href='x\">never", "one"), ("<article><p>one<b", "one"),
        ('<article><p title="class=ad">one<p data-class="ad">two<p class="x" class="ad">three<p CLASS=ad>four', "one\ntwo\nthree"),
        ("<article><p\u00a0x>one", "one"), ("<article><p>a<br / >c", "a c"),
    ]:
        assert text(page) == expected, page


def test_any_tag_soup_is_read():
    rng = random.Random(9)
    parts = ["<p>", "</p>", "<div class=x>", "</div>", "<table>", "<tr>", "<td>", "</table>", "<li>", "<ul>", "</ul>", "<", ">", "&", "&lt;", '"', "<!--", "-->", "a", "<b>", "</b>", "<br/>", "<article>", "</article>", "<body>", "</html>"]
    for _ in range(500):
        text("".join(rng.choice(parts) for _ in range(40)))


def page(i, body):
    return (i, f"http://H.example/{i}", body, "x", "y")


def test_template_of_a_host_goes(spark):
    box = "<div><span>Subscribe now</span><div>to all our news</div></div>"
    rows = [page(i, f"<body>{box}<div><p>own text {i}</p></div><div>foot {i % 2}</div></body>") for i in range(40)]
    rows += [(100 + i, "http://other.example/", f"<body>{box}<p>text {i}</p></body>", "x", "y") for i in range(3)]
    rows += [page(200 + i, f"<article><p>said often</p>{box}<p>{i}</p></article>") for i in range(30)]
    found = {r.row.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(found[i] == f"own text {i}" for i in range(40))
    assert all(found[100 + i] == f"Subscribe now\nto all our news\ntext {i}" for i in range(3))  # too few pages
    assert all(found[200 + i] == f"said often\n{i}" for i in range(30))  # paragraphs of an article are no template


def test_content_of_copied_pages_stays(spark):
    body = "<h1>t</h1><p>one</p><ul><li>x</ul><section><p>two</p></section><div><div><p>four</p></div></div><table><tr><td><div>a</div></table>"
    rows = [page(i, f"<body><div>menu {i}</div><div><article>{body}</article></div></body>") for i in range(12)]  # the list, section and wrappers of an article
    rows += [page(100 + i, f"<body>{body}</body>") for i in range(12)]  # a page without an article
    rows += [page(200 + i, f"<article>{body}<p>{i}</p></article>") for i in range(12)]  # near copies
    found = {r.row.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    whole = "t\none\nx\ntwo\nfour\na"
    assert all(found[i] == found[100 + i] == whole for i in range(12))
    assert all(found[200 + i] == f"{whole}\n{i}" for i in range(12))


def test_names_of_layout_skip_no_article():
    inner = "<h1>t</h1><p>one</p>"
    for source, expected in [
        (f'<div class="content-sidebar-wrap"><main>{inner}</main></div>', "t\none"), (f'<body class="no-sidebar"><article>{inner}</article></body>', "t\none"),
        (f'<div class="has-header with-footer">{inner}</div>', "t\none"), (f'<article class="post comments-open">{inner}</article>', "t\none"),
        (f'<div id="sidebar"><div><article>{inner}</article></div></div><div class="sidebar">s</div>', "t\none"), (f'<body class="comments">{inner}</body>', "t\none"),
        (f'<main><div id="comments"><article class="comment">{inner}</article></div></main>', "t\none"),  # all the page has
        (f'<main>{inner}</main><ol class="comment-list"><li><article class="comment">mine</article></ol>', "t\none"),
        (f'<article>{inner}<div class="share-box">s</div><div class="cookie-banner">s</div><div class="ad x">s</div><div id="comments">c</div></article>', "t\none"),
        ('<div class="sidebar">s<aside><article>a</article></aside></div><p>b</p>', "b"), ('<div class="notice"><p>n</p></div>', "n"),
    ]:
        assert text(source) == expected, source


def test_doubtful_names_are_counted(spark):
    rows = [page(i, f'<article><p>{i}</p><div class="related-posts"><ul><li>x</ul></div><div class="no-sidebar"><p>said often</p></div></article>') for i in range(12)]
    found = {r.row.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(found[i] == f"{i}\nsaid often" for i in range(12))


def test_odd_rows(spark):
    rows = [(None, None, None, "x", "y"), (1, None, "<p>a", "x", "y"), (1, None, "<p>a", "x", "y"), (2, "http://h/", "", "x", "y")]
    found = htmltext.extract(spark.createDataFrame(rows, SCHEMA), carry=("page_id", "text", "host")).collect()
    assert sorted((str(r.row.page_id), r.row.text, r.row.host, r.text) for r in found) == [("1", "x", "y", "a"), ("1", "x", "y", "a"), ("2", "x", "y", ""), ("None", "x", "y", "")]
    assert htmltext.extract(spark.createDataFrame([], SCHEMA)).collect() == []
