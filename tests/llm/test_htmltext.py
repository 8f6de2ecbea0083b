import html
import random
import re
import statistics
import tracemalloc

import pytest
from pyspark.sql import functions as F

from ledgerstream.llm import htmltext
from ledgerstream.llm.htmltext import extract, main_text
from ledgerstream.llm.queries import QUERIES

BODY = "".join(f"<p>Paragraph {i}, with text; and more of it, as texts have.</p>\n" for i in range(4))
TEXT = "\n".join(f"Paragraph {i}, with text; and more of it, as texts have." for i in range(4))


@pytest.mark.parametrize("around", [
    "<nav><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></nav>{}",
    "<header><h1>Site, the best</h1></header>{}<footer>(c) All of us, 2020.</footer>",
    "{}<aside><p>Aside, long text, with marks, and more of them, too, and more.</p></aside>",
    "<div class='cookie-notice'>We use cookies, yes, we do.</div>{}",
    "{}<div id=\"comments\"><div class=comment><p>Nice, very nice, so nice, really, I say.</p></div></div>",
    "{}<form><p>Sign up, please.</p><input><textarea>Type, here</textarea></form>",
    "<script>if (a < b) document.write('<p>No, not this.</p>')</script><style>p > b {{x: 1}}</style>{}",
    "<!-- <p>Not, this.</p> -->{}<!-- open, comment",
    "<div class='ad'>Buy, now. Cheap, good.</div>{}<div role=navigation>Pages, 1, 2</div>",
    "<div hidden>Hidden, words.</div><div style='display: none'>More, words.</div>{}"])
@pytest.mark.parametrize("article", ["<article>{}</article>", "<main><div class=text>{}</div></main>", "<div id=content>{}</div>"])
def test_article_alone(around, article):
    assert main_text("<html><body>" + around.format(article.format(BODY)) + "</body></html>") == TEXT


def test_blocks_space_and_references():
    page = "<article><h1>A &amp; B</h1><p> x&nbsp;y,\n\t z<br>w <b>bold<i>er</b> &eacute;&#x4e2d;<p>next, one.<li>item</li></article>"
    assert main_text(page) == "A & B\nx y, z w bolder é中\nnext, one.\nitem"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("just text", "just text"), ("a < b", "a < b"),
    ("<p>cut off in a tag <a href='x", "cut off in a tag"), ("</p></div>stray, ends", "stray, ends"),
    ("<script>never closed, <p>no</p>", ""), ("<p a=\"1>2\">quoted, mark</p>", "quoted, mark")])
def test_broken_pages(page, text):
    assert main_text(page) == text


def test_long_and_deep_pages():
    assert main_text("<div>" * 3000 + "deep, text." + "</div>" * 3000) == "deep, text."
    assert len(main_text("<article>" + "<p>some, words here.</p>" * 20_000 + "</article>").split("\n")) == 20_000


def test_rows_of_the_table(spark, sf_dir):
    for r in QUERIES["op3_tag_path_text"](spark, sf_dir).join(
            spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        plain = [" ".join(html.unescape(b.replace("<br>", " ")).split())
                 for b in re.split(r"</?(?:p|h1|div)[^>]*>", re.sub("</?b>", "", inside))]
        assert r.text == "\n".join(p for p in plain if p) and r.n_chars == len(r.text)


def test_nulls_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<p>a, b</p>"), (1, None, None)], "page_id bigint, url string, html string")
    assert sorted((r.t for r in pages.select(extract(F.col("html")).alias("t")).collect())) == ["", "", "a, b"]
    assert pages.limit(0).select(extract(F.col("html"))).count() == 0


def test_no_chosen_block_is_left_out():
    card = "<article><p>Card text, short; and some more of it, as cards have.</p></article>"
    inside = main_text(f"<html><body><div id=content>{BODY}{card}</div></body></html>")
    assert all(line in inside for line in TEXT.split("\n"))
    halves = BODY.split("\n")
    split = "".join(f"<article>{''.join(part)}</article>" for part in (halves[:2], halves[2:]))
    assert main_text(f"<html><body><div id=content>{split}</div></body></html>") == TEXT


def lines(page):
    return main_text(page).split("\n")


def test_marks_weigh_and_do_not_cut():
    """Words of class that mark a wrapper of the page, parts of words, inline elements, references."""
    assert main_text(f'<body><div class="layout sidebar-right">{BODY}</div></body>') == TEXT
    page = (f"<article>{BODY}<p>code <span class='hljs-comment'>note, it</span> x.</p><div class='share-text'>Share, of text.</div>"
            "<h1 class='alert-title'>T</h1><ul><li><a href=x>ref one</a></ul><p>Area is <label>so</label> <math>x</math> metres, "
            "<button>b</button> <object>o</object>.</p><fieldset>Set, of fields.</fieldset></article>")
    assert main_text(page) == TEXT + "\n" + "\n".join(
        ["code note, it x.", "Share, of text.", "T", "ref one", "Area is so x metres, b o.", "Set, of fields."])


def test_places_of_content():
    card = "<article><p>Card text, short.</p></article>"
    beside = lines(f"<body><div id=content>{BODY}</div>{card}<nav><a href=/>Home</a></nav></body>")
    assert set(TEXT.split("\n")) <= set(beside) and "Home" not in beside
    halves = BODY.split("\n")
    two = "".join(f"<article><h2>Part</h2>{''.join(part)}</article>" for part in (halves[:2], halves[2:]))
    found = lines(f"<body><header>Site, the best.</header><div>{two}</div><footer>(c) us, all.</footer></body>")
    assert [x for x in found if x != "Part"] == TEXT.split("\n") and found.count("Part") == 2
    assert main_text(f"<body><h1>Title</h1><div><div>{BODY}</div></div><footer>(c) us, all.</footer></body>") == "Title\n" + TEXT


def test_scores_decide(monkeypatch):
    """With scores drawn at random most pages give other rows."""
    page = f"<body><nav><ul><li>Home, now.<li>More, then.</ul></nav><article>{BODY}</article><footer>All of us, 2020.</footer></body>"
    assert main_text(page) == TEXT
    rng = random.Random(1)

    def drawn(blocks):
        for b in blocks:
            b.score = rng.random()

    monkeypatch.setattr(htmltext, "score", drawn)
    assert sum(main_text(page) != TEXT for _ in range(20)) > 10


def test_scores_like_brute_force():
    """From the definition, on a page with known paths; its two paragraphs outside stand beside by weight."""
    page = f"<body><nav><p>Go, on.</p><p>Up, too.</p></nav><article><h1>Title</h1>{BODY}<p>Short.</p></article></body>"
    blocks, elements = htmltext.blocks_of(page)
    htmltext.weigh(blocks, elements)
    htmltext.score(blocks)
    texts = ["Go, on.", "Up, too.", "Title", *TEXT.split("\n"), "Short."]
    paths = ["nav"] * 2 + ["h1"] + ["p"] * 5
    marks = lambda t: sum(c in ".,;:!?" for c in t)
    mean = lambda f, p: statistics.mean(f(t) for t, q in zip(texts, paths) if q == p)
    raw = [mean(len, p) * (1 + mean(marks, p)) for p in paths]
    kernel = [2.718281828459045 ** (-0.5 * d * d) for d in range(-2, 3)]
    around = [sum(k * raw[i + d] for k, d in zip(kernel, range(-2, 3)) if 0 <= i + d < len(raw)) / sum(kernel) for i in range(len(raw))]
    weights = [0.05 if p == "nav" else 2.0 for p in paths]
    assert [b.text for b in blocks] == texts
    assert [b.score for b in blocks] == pytest.approx([w * (a * r) ** 0.5 for w, a, r in zip(weights, around, raw)])
    content = htmltext.content_paths(blocks)
    expected = {p for p in paths if statistics.mean(b.score for b, q in zip(blocks, paths) if q == p) >= statistics.pstdev(b.score for b in blocks)}
    assert {p for b, p in zip(blocks, paths) if b.holder.path in content} == expected


def test_memory_of_deep_pages():
    page = "<body>" + "<div><p>some, words here.</p>" * 20_000
    tracemalloc.start()
    assert len(lines(page)) == 20_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6


def test_clashing_columns(spark):
    pages = spark.createDataFrame([("<p>a, b</p>", 1, 2, 3)], "html string, text int, score int, path int")
    assert pages.select("*", extract(F.col("html")).alias("found")).first().found == "a, b"
