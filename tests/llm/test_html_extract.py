import pytest

from revmart.llm import html_extract as op

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{x}</style><script>var t="</p><p>no</p>";</script></head><body>
<nav><ul><li><a href=a>Menu {k}</a></li><li><a href=b>More</a></li></ul></nav><div class="ad">Buy {k}</div>
<article><h1>Title {k} &amp;amp; &lt;b&gt;</h1><p><b>First  {k}<br><p>Second&nbsp;\n{k} &copy; <i>in</i>line<div class='related-posts'><p>other</p></div>
<ul><li>one<li>two {k}</ul><form><p>Name</p></form><span class="ad">promo</span><section id="comments"><p>reader {k}</p></section></article>
<aside>side {k}</aside><footer>&copy; host &middot; {k}</footer></body></html>"""
TEXT = "Title {k} &amp; <b>\nFirst {k}\nSecond {k} © inline\none\ntwo {k}"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], "page_id long, url string, html string, host string, tree_id string, text string, slots string")


def texts(df):
    return sorted(((r["page_id"], r["text"]) for r in df.collect()), key=repr)


def run(spark, rows):
    return texts(op.extract(pages(spark, rows), keep=("page_id",)))


def fill(k):
    return PAGE.replace("{k}", str(k))


def test_articles(spark):
    rows = [(k, f"http://{'hot.example.org' if k % 3 else 'b.example.com:80'}/x/{k}?q=1", fill(k)) for k in range(12)]
    assert run(spark, rows) == sorted(((k, TEXT.replace("{k}", str(k))) for k in range(12)), key=repr)


def test_awkward_rows(spark):
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    rows = [(1, None, None), (2, "http://a/", ""), (3, "http://a/", fill(3)), (3, "http://a/", fill(3)), (None, "nonsense", "<p>loose <b>text"),
            (4, "//c/", "<article><p>cut off <a href='x"), (5, "http://d/", "plain & simple < 3"), (6, "http://d/", "<!-- only"), (7, "HTTP://U@D:1/", deep),
            (8, "http://e/", "<article>" + "".join(f"<p>par {k}</p>" for k in range(3000)) + "</article>")]
    got = dict(run(spark, [r for r in rows if r[0] != 3]))
    assert got[1] == got[2] == got[6] == ""
    assert got[4].startswith("cut off") and got[5] == "plain & simple < 3" and got[7] == "deep text" and got[None] == "loose text"
    assert got[8] == "\n".join(f"par {k}" for k in range(3000))
    assert [t for i, t in run(spark, rows) if i == 3] == [TEXT.replace("{k}", "3")] * 2


def test_template_without_landmark(spark):
    """Without an article element, what is the same on all pages of a host is
    template and what varies is content."""
    html = "<body><div class='top'>Welcome to the site</div><div class='body'><p>Story {k} of many</p><p>It ends {k}</p></div><div class='end'>All rights reserved</div></body>"
    rows = [(k, "http://news.example.org/a", html.replace("{k}", str(k))) for k in range(8)]
    assert run(spark, rows) == sorted(((k, f"Story {k} of many\nIt ends {k}") for k in range(8)), key=repr)


def test_constant_blocks_inside_landmarks_are_template(spark):
    """What is the same on all pages of a host goes inside article and main
    too; hosts with few pages have nothing but the landmark to go by."""
    art = "<body><article><h1>Title {k}</h1><div class='x'><p>Get our letter every week</p></div><p>Story {k}</p></article><div>outside {k}</div></body>"
    main = "<body><main><div class='top'>Welcome to the site</div><h2>Title {k}</h2><div class='b'><p>Story {k}</p></div><div class='end'>All rights reserved</div></main></body>"
    rows = [(k, "http://a.example.org/", art.replace("{k}", str(k))) for k in range(8)]
    rows += [(k + 100, "http://m.example.org/", main.replace("{k}", str(k))) for k in range(8)]
    rows += [(k + 200, "http://few.example.org/", art.replace("{k}", str(k))) for k in range(2)]
    want = [(k, f"Title {k}\nStory {k}") for k in range(8)] + [(k + 100, f"Title {k}\nStory {k}") for k in range(8)]
    want += [(k + 200, f"Title {k}\nGet our letter every week\nStory {k}") for k in range(2)]
    assert run(spark, rows) == sorted(want, key=repr)


@pytest.mark.parametrize("around", ["div", "main"])
def test_teaser_articles_beside_a_story(spark, around):
    """A story in a div is found although other parts of the page are articles."""
    story = " ".join(["A long story about {k} that goes on and on."] * 12)
    teaser = "<article class='t{j}'><h3><a href='x'>Next {k} {j}</a></h3><p>Short {j} of {k}</p></article>"
    html = f"<body><{around}><div class='s'><h1>Title {{k}}</h1><p>{story}</p></div>" + "".join(teaser.replace("{j}", j) for j in "abc") + f"</{around}></body>"
    rows = [(k, "http://t.example.org/", html.replace("{k}", str(k))) for k in range(8)]
    assert run(spark, rows) == sorted(((k, f"Title {k}\n" + story.replace("{k}", str(k))) for k in range(8)), key=repr)


def test_a_list_of_articles_stays(spark):
    html = "<body><div class='top'>Latest {k}</div>" + "".join(f"<article class='p{j}'><h2><a href='x'>Post {j} {{k}}</a></h2><p>Text {j} of page {{k}}</p></article>" for j in "abc") + "</body>"
    rows = [(k, "http://l.example.org/", html.replace("{k}", str(k))) for k in range(8)]
    assert run(spark, rows) == sorted(((k, "\n".join(f"Post {j} {k}\nText {j} of page {k}" for j in "abc")) for k in range(8)), key=repr)


def test_classes_of_the_whole_page_rule_nothing_out(spark):
    html = "<body class='has-sidebar'><div class='header-wrap'><main class='with-menu'><p>Text</p><div class='menu'>no</div></main></div></body>"
    assert run(spark, [(1, "http://w.example.org/", html)]) == [(1, "Text")]


def test_copies_are_no_template(spark):
    html = "<body><div><p>The same story</p></div></body>"
    assert run(spark, [(k, "http://copy.example.org/", html) for k in range(9)]) == [(k, "The same story") for k in range(9)]


def test_simple_tree_match():
    a = op.read_skeleton("#(html(body(nav(ul(li ) ) article(h1 p ul(li ) p ) footer ) ) )")
    b = op.read_skeleton("#(html(body(div article(h1 p ) footer ) ) )")
    m = op.simple_tree_match(a, b)
    labels = {a[i][0] + str(i): (b[j][0] if j >= 0 else None) for i, j in enumerate(m)}
    assert labels == {"#0": "#", "html1": "html", "body2": "body", "nav3": None, "ul4": None, "li5": None, "article6": "article",
                      "h17": "h1", "p8": "p", "ul9": None, "li10": None, "p11": None, "footer12": "footer"} or sum(x is None for x in labels.values()) == 6
    assert sum(j >= 0 for j in m) == 7


@pytest.mark.parametrize("rows", [[]])
def test_empty_table(spark, rows):
    assert op.extract(pages(spark, rows), keep=("page_id",)).count() == 0
