"""Main text of pages of several shapes."""

import random
import re
import time
import html as escapes

from tallyloom.llm import page_text as pt
from tallyloom.llm.registry import QUERIES

PAGES = "page_id BIGINT, url STRING, html STRING, text INT"
WORDS = "some longer run of plain words that goes on for a while and says little "


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def boilerplate(inner):
    return page(
        '<header>Site name</header><nav><ul><li><a href="/a">Home</a></li><li><a>News</a></li></ul></nav>'
        '<div class="cookie-notice">We use cookies and more words here to be sure of it</div>'
        + inner
        + '<div id="comments"><p>' + "reader says many words " * 9 + "</p></div>"
        '<aside><p>Related reading in the margin</p></aside><form><label>Mail</label></form><footer><p>&copy; all rights</p></footer>'
    )


MARKED = boilerplate(
    f"<article><h1>Head  &amp; line</h1><p><b>{WORDS}</b><br>second &lt;line&gt;<script>var x='</p>';</script></p>"
    f"<div class=\"ad\">Buy now</div><p>{WORDS}</p><ul><li>{WORDS}</li></ul></article>"
)
TEXT = [f"Head & line", f"{WORDS}second <line>", WORDS.strip(), WORDS.strip()]


def test_shapes(spark):
    plain = boilerplate(f"<div id=content><p>{WORDS}<p>{WORDS}</div>")
    cut = MARKED[: MARKED.index("</article>")]
    rows = [(1, "u", MARKED, 1), (2, None, plain, 1), (3, "u", cut, 1), (4, "u", None, 1), (5, "u", "", None), (None, "u", "<p", 1)]
    rows += [(1, "u", MARKED, 1), (6, "u", page("<nav><a>Home</a></nav>"), 1), (7, "u", "no markup at all &amp; that's it", 1)]
    frame = spark.createDataFrame(rows, PAGES)
    found = pt.extract_pages(frame, pt.fit_page_weights(frame)).collect()
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[1] == "\n\n".join(TEXT)
    assert texts[2] == "\n\n".join([WORDS.strip()] * 2)
    assert texts[3] == texts[1]
    assert texts[4] == texts[5] == texts[6] == "" and texts[7] == "no markup at all & that's it"
    assert pt.extract_pages(frame.limit(0), pt.fit_page_weights(frame.limit(0))).count() == 0


def texts_of(*bodies):
    weights = pt.PageWeights({"link": 0.1}, {})
    return [pt.main_text(page(b), weights) for b in bodies]


def test_hints_do_not_take_the_content():
    text = WORDS.strip()
    wrapped = [
        f'<div class="content no-sidebar"><article><p>{WORDS}</p></article></div>',
        f'<div id=page class="has-sidebar"><p>{WORDS}</p><p>{WORDS}</p></div>',
        f'<div class="with-banner"><p>{WORDS}</p></div>',
        f'<div class="layout-sidebar"><main><p>{WORDS}</p></main><div class="sidebar">x y</div></div>',
        f'<div class="sidebar"><p>{WORDS}</p><p>{WORDS}</p></div><p>a b</p>',
        f'<div class="overflow hidden x"><p>{WORDS}</p></div><div class="c"><p>{WORDS}</p></div>',
    ]
    for found in texts_of(*wrapped):
        assert text in found and "x y" not in found
    blocks = "".join(f'<div class="{c}">{c} {WORDS}</div>' for c in ("entry-header", "related-work", "share-price", "notice"))
    inside = texts_of(f"<article><p>{WORDS * 9}</p>{blocks}<div class='related-posts'>gone</div><p hidden>gone</p></article>")[0]
    assert all(c in inside for c in ("entry-header", "related-work", "share-price", "notice")) and "gone" not in inside
    comments = "reader words " * 40
    assert comments.strip() not in texts_of(f"<article><p>{WORDS}</p></article><div class=comments><article class=comment><p>{comments}</p></article></div>")[0]


def test_hinted_elements_without_end_tags():
    for body in (
        f"<p class=notice>gone<p>{WORDS}</p><p>{WORDS}</p><p>{WORDS}</p>",
        f"<ul><li class=share>gone<li>{WORDS}</ul><div><p>{WORDS}</p></div><ul><li>{WORDS}</li></ul>",
        f"<dl><dt class=ad>gone<dd>{WORDS}</dl><div>{WORDS}</div><dl><dt>{WORDS}</dt></dl>",
        f"<table><tr><td class=ad>gone<td>{WORDS}<tr><td>{WORDS}</table><div>{WORDS}</div><table><tr><td></td></tr></table>",
        f"<div><p class=notice>gone</div><p>{WORDS}</p><p>{WORDS}</p><p>{WORDS}</p>",
        f"<p>{WORDS}</p><div class=ad><p>{WORDS}</p><p>{WORDS}</p>",
    ):
        found = texts_of(body)[0]
        assert found.count(WORDS.strip()) == 3 and "gone" not in found, body


def test_best_run():
    assert pt.best_run([]) == (0, 0) and pt.best_run([-1.0, -2.0]) == (0, 0)
    assert pt.best_run([-1.0, 3.0, -1.0, 4.0, -9.0, 5.0]) == (1, 4)


def test_registered_query(spark, tables):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{tables}/pages.parquet").collect()}
    for r in QUERIES["op8_page_text"](spark, tables).collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer|$)", pages[r["page_id"]], re.S)[1]
        blocks = (escapes.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))) for b in re.split("</?p>|</?h1>", inner))
        assert r["text"] == "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def test_hostile_pages_take_time_in_proportion():
    shapes = (
        lambda n: "<span>" * n + "</q>" * n,
        lambda n: "<li><ul>" + "<span>" * n + "<li>" * n,
        lambda n: "<nav>" * n,
        lambda n: "<div class=ad>w " * n + "</div>" * n,
    )
    for shape in shapes:
        start = time.process_time()
        pt.read_page(shape(30_000))
        # Searching the open elements from the top took minutes here.
        assert time.process_time() - start < 10


def test_open_elements_against_a_search_from_the_top():
    draw = random.Random(6)
    names = ["p", "li", "ul", "table", "td", "span", "tr"]

    def found_plainly(opened, wanted, walls):
        found = -1
        for k in range(len(opened) - 1, -1, -1):
            if opened[k] in wanted:
                found = k
            elif opened[k] in walls:
                break
        return found

    def closed_plainly(opened, name, walls):
        for k in range(len(opened) - 1, -1, -1):
            if opened[k] == name:
                return k
            if opened[k] in walls:
                return -1
        return -1

    elements = pt.OpenElements()
    for _ in range(4000):
        opened = [n for n, _ in elements.opened]
        wanted, walls = frozenset(draw.sample(names, 2)), frozenset(draw.sample(names, 2))
        assert elements.find(wanted, walls) == found_plainly(opened, wanted, walls)
        name = draw.choice(names)
        walls = {"table"} if name in pt._TABLE else pt._WALLS
        place = elements.closed_by(name)
        assert place == closed_plainly(opened, name, walls)
        if place >= 0 and draw.random() < 0.4:
            assert [n for n, _ in elements.close(place)] == opened[place:][::-1]
        else:
            elements.open(draw.choice(names), -1)
