import re
from html import unescape

from tideline.llm import html_extract
from tideline.llm.html_blocks import parse
from tideline.llm.html_pages import labelled_pages
from tideline.llm.queries import op3_html


def texts(source):
    return [b.text for b in parse(source).blocks]


def test_blocks():
    assert texts(None) == texts("") == texts("<p> </p>") == []
    assert texts("a<br>b<p>c &amp; d&#33;</p>e <b>f</b>\n g") == ["a b", "c & d!", "e f g"]
    assert texts("<p>x<p>y<ul><li>1<li>2</ul><!-- n --><script>var a='<p>no</p>'</script>z") == ["x", "y", "1", "2", "z"]
    assert texts("<p title='a>b'>x</p><p title=\"open>y</p>") == ["x", "y"]
    assert texts("<div>x</b></i></div>&amp; cut &a <p") == ["x", "& cut &a"]
    assert texts("<style>p{}</style><title>T</title><textarea>no</textarea>y<!-- open") == ["y"]
    assert parse("<title>a\n b</title>").title == "a b"
    assert texts("<p>a</p><noscript><p>Enable JavaScript.</p></noscript>b") == ["a", "b"]
    assert texts("<div>" * 5000 + "deep" + "</div>" * 5000) == ["deep"]
    assert len(texts("<p>w w w</p>" * 20_000)) == 20_000


def test_viterbi_is_the_best_path():
    model = html_extract.trained()
    (a, b), (c, d) = model._steps
    for source in labelled_pages(8, seed=3):
        page = parse(source)
        page.blocks = page.blocks[:10]
        gain = [sum(model.weights.get(f, 0.0) for f in html_extract.features(x)) for x in page.blocks]

        def score(path, gain=gain):
            total = model._start[path[0]] + sum(g for g, y in zip(gain, path, strict=True) if y)
            return total + sum(model._steps[x][y] for x, y in zip(path, path[1:]))

        n = len(page.blocks)
        best = max(score([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert abs(score([int(y) for y in model.decode(page)]) - best) < 1e-9


def test_held_out_layouts():
    wrong = n = 0
    for source in labelled_pages(150, seed=99):
        page = parse(source)
        for block, main in zip(page.blocks, html_extract.trained().decode(page), strict=True):
            n += 1
            wrong += bool(block.main) != main
    assert wrong < 0.02 * n


def test_a_page_by_hand():
    page = """<html><head><title>T</title></head><body><header class=site><h1>My Site</h1><nav><a href=/>Home</a></nav>
    </header><div id="cookie-banner"><p>We use cookies. Accept them, please.</p></div><div class="post-content">
    <h1>A title</h1><p>First, with   text &amp; a <a href=x>link</a>.</p><p>Second paragraph here.</p></div>
    <div class="sidebar"><h3>Related</h3><ul><li><a href=1>Other story</a></li></ul></div><section id="comments">
    <div class="comment"><p>I think this is great, really. Thanks.</p></div></section><form><label>Mail</label></form>
    <footer><p>Copyright 2024. All rights reserved.</p></footer></body></html>"""
    expected = "A title\n\nFirst, with text & a link.\n\nSecond paragraph here."
    assert html_extract.trained().main_text(page) == expected


def test_empty_training_and_page():
    assert html_extract.fit([]).main_text("<p>x</p>") in ("", "x")
    assert html_extract.trained().main_text(None) == ""


def test_query_against_the_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    found = op3_html(spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]]["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>?", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_frames(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (3, "<article><p>Hi there, you all.</p></article>", "c")], "page_id long, html string, text string")
    found = rows.select("page_id", html_extract.main_text(rows["html"], html_extract.trained()).alias("t"))
    assert sorted((r["page_id"], r["t"]) for r in found.collect()) == [(1, ""), (2, ""), (2, ""), (3, "Hi there, you all.")]
    assert found.limit(0).collect() == []
