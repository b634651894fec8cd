import pytest
from navloom.llm import html_templates
from navloom.llm.html_templates import deduce, main_text

ARTICLE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav>
<div class="cookie-notice">Cookies?</div><aside>Side</aside><div id="ad1" class="ad">Buy</div>
<article class="post"><header class="article-header"><h1>Head&shy;line</h1></header>
<p><b>First &lt;one&gt;<br>two  <i>th</i>ree<p>Second &#233;&nbsp;x</p><!-- hidden --><figure><figcaption>Caption</figcaption></figure>
<div class="share-buttons">Share</div><form><input value="q">Ask</form><table><tr><td>A<td>B</table>
<section class="comments"><article class="comment"><p>Nice</p></article></section></article>
<div id="comments"><p>Reader</p></div><footer>End</footer></body></html>"""


def test_article_by_hand():
    expected = ["Head\xadline", "First <one> two three", "Second é x", "Caption", "A", "B"]
    assert main_text(ARTICLE, None, frozenset()) == "\n\n".join(expected)


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("", ""),
        ("plain &amp; text", "plain & text"),
        ("<p>a<p>b</div></p>c", "a\n\nb\n\nc"),
        ("<p>a > b < c</p>", "a > b < c"),
        ("<script>x", ""),
        ("<p title='>'>q</p><textarea><p>t</textarea>", "q"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\n\nb\n\nc\n\nd"),
        ("<main><p>in</p></main><p>out</p>", "in"),
        ("<div role=main>x</div><div role='navigation'>y</div>", "x"),
        ("<!-- <p>no</p>", ""),
    ],
)
def test_pieces(source, expected):
    assert main_text(source, None, frozenset()) == expected


def page(i, host="h.example"):
    items = "".join(f"<li>item {i} {k}</li>" for k in range(i % 4 + 1))
    return f"""<html><body><div class="top">Welcome to the host</div><div class="layout"><div class="text"><h2>Title {i}</h2>
    <p>Paragraph {i} of many words and a few more of them to fill it.</p><p>Same passage.</p><ul>{items}</ul></div></div>
    <div class="low">All rights reserved</div></body></html>"""


def run(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, main string")
    return {r.page_id: r.text for r in html_templates.extract(pages).collect()}


def test_template_text_goes_and_slots_stay(spark):
    rows = [(i, f"https://H.example/{i}", page(i), "x", "y", "z") for i in range(9)]
    rows += [(100, "https://other.example/1", page(100), None, None, None), (101, None, None, None, None, None)]
    rows += [(102, "http://[bad", "<p>bad url</p>", None, None, None), (103, "", "", "", "", "")]
    found = run(spark, rows)
    for i in range(9):
        items = [f"item {i} {k}" for k in range(i % 4 + 1)]
        assert found[i].split("\n\n") == [
            f"Title {i}", f"Paragraph {i} of many words and a few more of them to fill it.", *items
        ]
        assert "Welcome" not in found[i] and "rights" not in found[i]
    assert found[100].startswith("Welcome to the host\n\nTitle 100")  # a host of one page has no template
    assert found[101] == found[103] == "" and found[102] == "bad url"


def test_pages_that_come_twice_keep_their_vectors(spark):
    own = [page(i).replace("Same passage.", "Own passage." if i < 4 else f"Other {i}.") for i in range(6)]
    once = [(i, "https://h.example/", source, "x", "y", "z") for i, source in enumerate(own)]
    found = run(spark, once + once)
    assert found == run(spark, once)
    assert all("Own passage." in found[i] and "Welcome" not in found[i] for i in range(4))


def test_classes_nest_by_vector():
    def token(name, vector, pages, times, place, chars=0):
        number, kind = html_templates.token_of(*name.split("\n"))
        return {"token": number, "kind": kind, "depth": name.count("/") * (kind == 0), "vector": vector, "pages": pages,
                "times": times, "place": place, "chars": chars}

    def named(name):
        return html_templates.token_of(*name.split("\n"))[0]

    tokens = [
        token("", 1, 8, 8, 0, 100), token("/b", 1, 8, 8, 1, 100), token("/b/main", 1, 8, 8, 3, 95), token("/b/low", 1, 8, 8, 20, 5),
        token("/b/main/ul", 2, 8, 8, 5), token("/b/main/li", 2, 8, 16, 9), token("/rare\nonce", 3, 2, 2, 7),
        token("/b/low\nAll rights", 1, 8, 8, 21),
    ]
    main, texts, template = deduce(tokens)
    assert main == named("/b/main") and texts == [named("/b/low\nAll rights")]
    assert [(d, t) for d, _, t in template if t == named("/b/main/ul")] == [(1, named("/b/main/ul"))]
    assert all(t != named("/rare\nonce") for _, _, t in template)


def test_repeated_rows_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", ARTICLE)] * 3, "page_id long, url string, html string")
    rows = html_templates.extract(pages).collect()
    assert len(rows) == 3 and len({r.text for r in rows}) == 1
    assert html_templates.extract(pages.where("false")).count() == 0


def article(i, box="", top="", low=""):
    return f"""<html><body>{top}<article class="post"><h1>Title {i}</h1>{box}<p>Words of paragraph {i}.</p>
    <p class="relatedness-study">A study, number {i}.</p></article>{low}</body></html>"""


def hosted(spark, sources):
    return run(spark, [(i, "https://h.example/", source, None, None, None) for i, source in enumerate(sources)])


def test_a_box_all_pages_have_goes_from_their_articles(spark):
    found = hosted(spark, [article(i, "<div>Home News Sport</div>") for i in range(30)])
    assert found == {i: f"Title {i}\n\nWords of paragraph {i}.\n\nA study, number {i}." for i in range(30)}


def test_layouts_on_a_third_of_the_pages_are_templates(spark):
    pages = [
        f"<html><body><div>Welcome {i % 3} here</div><div><p>Words of {i}.</p><p>More of {i}.</p></div><div>Rights {i % 3}</div></body></html>"
        for i in range(30)
    ]
    assert hosted(spark, pages) == {i: f"Words of {i}.\n\nMore of {i}." for i in range(30)}
    framed = [page.replace("<div>W", f"<div class='l{i % 3}'>W") for i, page in enumerate(pages[:12])]
    assert hosted(spark, framed) == {i: f"Words of {i}.\n\nMore of {i}." for i in range(12)}


def test_copies_and_passages_of_articles_stay(spark):
    same = article(0, "<p>A passage of several words.</p><p>And another one.</p>")
    others = [article(i, "<p>A passage of several words.</p><p>And another one.</p>" if i < 9 else "") for i in range(1, 30)]
    found = hosted(spark, [same] * 20 + others)
    assert all("A passage of several words.\n\nAnd another one." in found[i] for i in range(28))
    assert found[0].startswith("Title 0") and found[48] == "Title 29\n\nWords of paragraph 29.\n\nA study, number 29."


def by_vectors(sources):
    """Texts of blocks that share counts per different page with another token, by the rules for classes."""
    pages = [html_templates.Page(s) for s in sorted(set(sources))]
    seen = {}
    for n, page in enumerate(pages):
        for path, (times, _) in page.elements.items():
            seen.setdefault((path,), {})[n] = times
        for path, text, declared, other, _ in page.blocks:
            if not other:
                counts = seen.setdefault((path, text, declared), {})
                counts[n] = counts.get(n, 0) + 1
    seen[("",)] = {n: 1 for n in range(len(pages))}
    classes = {}
    for token, counts in seen.items():
        classes.setdefault(tuple(sorted(counts.items())), []).append(token)
    found = set()
    for counts, tokens in classes.items():
        for token in tokens if len(counts) >= 3 and len(tokens) >= 2 else []:
            layout = any(len(t) == 1 for t in tokens)
            need = len(pages) / 2 if token[-1] is True else 3 if layout else 8
            if len(token) > 1 and len(counts) >= need:
                found.add(html_templates.token_of(*token)[0])
    return sorted(found)


def test_templates_are_those_of_plain_vectors(spark):
    box = ["<div>Box</div>", "<div class=x>Own<p>frame</p></div>", ""]
    sources = [article(i, box[i % 3], f"<div>Top {i % 2}</div><div>Go {i % 2}</div>", "<div class=l>Low</div>" * (i % 4 > 0)) for i in range(24)]
    rows = [(i, "https://h.example/", s) for i, s in enumerate([*sources, *sources[:9]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_templates.templates(pages).collect()
    assert [sorted(r.texts) for r in got] == [by_vectors(sources)] and len(got[0].texts) >= 5


def test_very_long_pages_and_repeated_ids(spark):
    long = "<html><body>" + "".join(f"<p>Sentence {k} of it.</p>" for k in range(30_000)) + "</body></html>"
    found = spark.createDataFrame([(1, "http://a.b/", long), (1, "http://a.b/", "<p>x</p>"), (None, None, "<p>y</p>")], "page_id long, url string, html string")
    texts = sorted((r.page_id or 0, len(r.text.split("\n\n"))) for r in html_templates.extract(found).collect())
    assert texts == [(0, 1), (1, 1), (1, 30_000)]
