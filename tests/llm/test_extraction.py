"""Main text of pages: hand-made pages, damaged markup, and templates of a host."""

import pytest
from pyspark.sql import functions as F

from roadlens.llm import extraction as E
from roadlens.llm.markup import read_page

PAGES = "page_id long, url string, html string"


def text(source, words=(), main=None):
    return E.main_text(read_page(source), set(words), main)


@pytest.mark.parametrize(
    "source,want",
    [
        ("", ""),
        ("plain", "plain"),
        ("<article><h1>T &amp; t</h1><p>a\n b&nbsp;c<br>d<p>e</article>", "T & t\n\na b c d\n\ne"),
        ("<nav><ul><li>x</ul></nav><article><p>a</p></article><footer>f</footer>", "a"),
        ("<article><p>a</p><aside>s</aside><div class='ad-box'>x</div><p>b <b>c</b>d</p><section id=comments><p>n</p></section></article>", "a\n\nb cd"),
        ("<article><p>a</p><form><p>x</p><input></form><div class='cookie-notice'>n</div></article>", "a"),
        ("<body><header class=h><h1>Site</h1></header><article><header><h1>Title</h1><p>by</p></header><p>a</p></article>", "Title\n\na"),
        ("<script>var t='</p><article>no</article>';</script><article><style>p{}</style><p>a</article>", "a"),
        ("<article><p>a<!-- <p>no</p> --> b<![CDATA[x]]></p><p title='1>0'>c</p>", "a b\n\nc"),
        ("<nav><ul><li>x<article><p>a</p></article>", "a"),
        ("<article><p>a</p></div></span><p>b", "a\n\nb"),
        ("<div id=sidebar><p>long long long long</p></div><div id=content><p>a</p><p>b</p></div>", "a\n\nb"),
        ("<article><p>a<p>1 < 2 & 3 &lt; 4 &#233;&#x1F600;</article>", "a\n\n1 < 2 & 3 < 4 é\U0001f600"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a\n\nb\n\nc d\n\ne"),
        ("<ARTICLE><P>a</P></ARTICLE", "a"),
    ],
)
def test_page(source, want):
    assert text(source) == want


@pytest.mark.parametrize(
    "source,want",
    [
        ("<div id=content><h1>T</h1><div class=body><p>long long</p><p>b</p></div></div>", "T\n\nlong long\n\nb"),
        ("<section id=intro><p>a</p></section><section id=methods><p>long long</p></section>", "a\n\nlong long"),
        ("<div><p>before</p><table><tr><td><p>a cell a cell</p><td><div>another cell</div></table><p>after</p></div>", "before\n\na cell a cell\n\nanother cell\n\nafter"),
        ("<nav><p>n n n n n</p></nav><div><p>a</p></div><div class=sidebar><p>s</p></div><div><p>b</p></div>", "a\n\nb"),
    ],
)
def test_containers_side_by_side_are_all_kept(source, want):
    assert text(source) == want
    assert text(source, main="/html/body/div.other") == want


@pytest.mark.parametrize(
    "source,want",
    [
        ("<div class='layout has-sidebar'><article><p>a</p></article><div class=sidebar><p>s</p></div></div>", "a"),
        ("<div class=social><article><p>a</p></article><article><p>b</p></article></div>", "a\n\nb"),
        ("<article class='post social-share'><p>a a</p></article><article class='post social-share'><p>b</p></article>", "a a\n\nb"),
        ("<form id=aspnetForm><div id=nav><p>n</p></div><div><h1>T</h1><p>a</p></div></form>", "T\n\na"),
        ("<h1>Site</h1><form id=aspnetForm><div class=menu><p>n</p></div><p>" + "a " * 100 + "</p></form>", "Site\n\n" + "a " * 99 + "a"),
        ("<article><h1>T</h1><form id=aspnetForm><p>" + "a " * 50 + "</p><aside>s</aside></form></article>", "T\n\n" + "a " * 49 + "a"),
        ("<article><p>story story</p></article><div id=comments><article><p>c</p></article></div>", "story story"),
        ("<div><p>" + "a " * 100 + "</p></div><div><article><p>teaser</p></article></div>", "a " * 99 + "a\n\nteaser"),
    ],
)
def test_marks_hold_for_nothing_above_the_main_text(source, want):
    assert text(source) == want


PROSE = "<p>" + "prose " * 120 + "</p>"


@pytest.mark.parametrize(
    "part,want",
    [
        ("<h2 id='discussion'>Discussion</h2>", "Discussion"),
        ("<h3 id='binary-search'>Binary search</h3>", "Binary search"),
        ("<h3 id='search' class='comments'>Search</h3>", "Search"),
        ("<section id='related-work'><p>others did</p></section>", "others did"),
        ("<section id='search-results'><p>found</p></section>", "found"),
        ("<section id='responses'><p>they said</p></section>", "they said"),
        ("<div class='overflow-hidden'><p>a table</p></div>", "a table"),
        ("<p id='notice-period'>one month</p>", "one month"),
        ("<div class='ad-hoc-networks'><p>nodes</p></div>", "nodes"),
        ("<article><p>a reader says</p></article>", None),
        ("<div class='ad-box'><p>buy</p></div>", None),
        ("<p class='advert'>buy</p>", None),
        ("<div class='post-comments'><p>first</p></div>", None),
        ("<section id='comments'><p>first</p></section>", None),
        ("<div class='cookieNotice'><p>cookies</p></div>", None),
    ],
)
def test_a_name_marks_as_a_whole(part, want):
    prose = ("prose " * 120).strip()
    assert text(f"<article>{PROSE}{part}</article>") == (prose if want is None else f"{prose}\n\n{want}")


def test_deep_pages():
    # slots and marks below any depth, and thousands of elements that nobody closed
    deep = "<div>" * 40
    page = f"<body>{deep}<div class=menu><p>m</p></div><div class=story>{PROSE}<p>b</p></div></body>"
    assert text(page) == ("prose " * 120).strip() + "\n\nb"
    assert len({b.element.path for b in read_page("".join(f"<div>t{i}" for i in range(3000))).blocks}) == 3000
    assert text("<article>" + "".join(f"<b><div>t{i}" for i in range(3000))) == "\n\n".join(f"t{i}" for i in range(3000))
    assert max(len(b.element.path) for b in read_page("<div class=abcdefgh>x" * 500).blocks) < 1100


def test_template_words_inside_articles(spark, monkeypatch):
    page = "<html><body><article><h1>Title {0}</h1><p>{1}</p><div class=end><p>Thanks for reading to the end</p></div></article></body></html>"
    rows = [(i, f"http://h/{i}", page.format(i, f"story {i} " * 20)) for i in range(6)]
    frame = spark.createDataFrame(rows, PAGES)
    want = {i: f"Title {i}\n\n" + (f"story {i} " * 20).strip() for i in range(6)}
    assert {g["page_id"]: g["text"] for g in E.op1_html_extraction(frame).collect()} == want
    monkeypatch.setattr(E, "PAGES", 100)  # without templates the line stays
    got = {g["page_id"]: g["text"] for g in E.op1_html_extraction(frame).collect()}
    assert got == {i: t + "\n\nThanks for reading to the end" for i, t in want.items()}


def test_a_page_of_another_layout_than_its_hosts():
    assert text("<html><body><div class=content></div><form id=f><p>a</p></form></body></html>", main="/html/body") == "a"


def test_marks_of_the_hosts_main_slot_do_not_hold(spark):
    page = "<body><div class=promo-page><div class=menu><p>m {0}</p></div><p>{1}</p></div><div><p>x{0}</p></div></body>"
    rows = [(i, f"http://h/{i}", page.format(i, f"story {i} " * 20 if i else "a")) for i in range(10)]
    got = {g["page_id"]: g["text"] for g in E.op1_html_extraction(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == ("story 3 " * 20).strip() + "\n\nx3" and got[0] == "a\n\nx0"


def site(i, body):
    return (
        f"<html><body><nav><a href='/{i}'>n{i}</a></nav><div class=wrap><p>Read more on our site</p>"
        f"<div class=story>{body}</div><p>Share with friends</p></div><footer>f</footer></body></html>"
    )


def test_template_words_and_main_slot(spark):
    rows = [(i, f"http://h.example/{i}", site(i, "".join(f"<p>story {i} {j}</p>" for j in range(i % 3 + 1)))) for i in range(20)]
    rows += [(100, "http://small.example/a", site(1, "<p>only</p>")), (101, None, None), (102, "http://[bad", ""), (103, "x", "<article><p>é</p>")]
    rows += [rows[3]]
    frame = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("clash")).withColumn("words", F.lit(1))
    got = E.op1_html_extraction(frame).collect()
    assert len(got) == len(rows)
    by = {g["page_id"]: g for g in got}
    for i in range(20):
        assert by[i]["text"] == "\n\n".join(f"story {i} {j}" for j in range(i % 3 + 1))
    assert by[100]["text"] == "Read more on our site\n\nonly\n\nShare with friends"  # too few pages for a template
    assert (by[101]["text"], by[102]["text"], by[103]["n_chars"], by[101]["url"]) == ("", "", 1, None)


def test_a_template_from_three_pages_on(spark):
    rows = [(i, f"http://{n}/{i}", site(i, f"<p>the story {i} of three</p>")) for n in (2, 3) for i in range(n)]
    got = {g["url"]: g["text"] for g in E.op1_html_extraction(spark.createDataFrame(rows, PAGES)).collect()}
    assert got["http://3/1"] == "the story 1 of three"
    assert got["http://2/1"] == "Read more on our site\n\nthe story 1 of three\n\nShare with friends"


def test_repeated_rows_do_not_cancel(spark):
    # every row twice: the line stands on all pages but the first, the list on all but the last
    page = "<html><body><div><p>{0}</p>{1}{2}</div></body></html>"
    rows = [(i, f"http://h/{i}", page.format(f"story {i}", "<b>line</b>" * (i > 0), "<ul><li>x</ul>" * (i < 9))) for i in range(10)] * 2
    found = E.classes(spark.createDataFrame(rows, PAGES)).where("pages = 18").collect()
    line = {f["vector"] for f in found if f["path"].endswith("/b")}
    assert line and line.isdisjoint(f["vector"] for f in found if f["path"].endswith("/ul"))


def test_near_copies_keep_their_body(spark):
    body = "<h1>One title</h1><p>The first paragraph of all copies.</p><p>The second one.</p>"
    shapes = {
        "article": "<html><body><article>{0}<p>{1}</p></article></body></html>",
        "div": "<html><body><div class=nav>n</div><div class=text>{0}<p>{1}</p></div></body></html>",
        "apart": "<html><body><div class=text>{0}</div><div class=date><p>{1}</p></div></body></html>",
        "table": "<html><body><div>{0}<table><tr><td>{1}</td></tr></table></div></body></html>",
    }
    rows = [(i, f"http://{host}/{i}", page.format(body, f"date {i}")) for host, page in shapes.items() for i in range(12)]
    for g in E.op1_html_extraction(spark.createDataFrame(rows, PAGES)).collect():
        assert g["text"] == f"One title\n\nThe first paragraph of all copies.\n\nThe second one.\n\ndate {g['page_id']}", g["url"]


def test_classes_nest(spark):
    rows = [(i, "http://h/", site(i, "".join(f"<p>s {i} {j}</p>" for j in range(i % 3 + 1)))) for i in range(12)]
    found = E.templates(E.classes(spark.createDataFrame(rows, PAGES))).collect()
    root = next(f for f in found if "/html" in f["paths"])
    assert root["parent"] is None and "/html/body/div.wrap/div.story" in root["paths"] and len(root["words"]) == 3
    filling = next(f for f in found if f["paths"] == ["/html/body/div.wrap/div.story/p"])
    assert (filling["parent"]["pages"], filling["parent"]["vector"]) == (root["pages"], root["vector"])


def test_empty_table(spark):
    assert E.op1_html_extraction(spark.createDataFrame([], PAGES)).count() == 0


def test_whole_table_equals_the_article_element(spark, smoke_dir):
    import html
    import re

    got = {g["page_id"]: g["text"] for g in E.op1_html_extraction(spark.read.parquet(f"{smoke_dir}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{smoke_dir}/pages.parquet").collect():
        body = r["html"].split("<article>", 1)[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[r["page_id"]] == "\n\n".join(x for x in parts if x)
