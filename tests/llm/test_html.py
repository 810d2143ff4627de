"""Main text of pages that mark no article, and of pages made to take time or memory."""

from __future__ import annotations

import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollweave.llm import htmltext

PARAS = [
    "The ferry left the harbour at dawn, with forty passengers, two dogs and a crate of oranges; nobody aboard had slept much.",
    "By noon the wind had turned. The captain, who had seen worse, kept the bow to the swell, and told the cook to wait with the soup.",
    "They reached the island late, in rain, and the whole village stood on the quay: it was the first boat in nine days.",
    "What the papers wrote about it later was mostly wrong, as papers are, but one of them printed the list of names.",
]
BODY = "".join(f"<p>{p}</p>" for p in PARAS)
TEXT = "\n".join(PARAS)
NAV = "<ul><li><a href=/>Home</a><li><a href=/a>Archive</a><li><a href=/b>About us</a></ul>"
SHORT = ["Great read", "Thanks for this", "Was there too", "lol", "So true", "My uncle was on it", "first", "More please"]
#: No mark says that these are comments.
REPLIES = "<div>" + "".join(f"<div><b>user{k}</b><div>{t}</div></div>" for k, t in enumerate(SHORT)) + "</div>"

#: Class and id words that sound like something else around the whole article.
WRAPPERS = [
    "class='overflow-hidden'", "class='has-sidebar'", "class='content right-sidebar'", "class='row no-sidebar'", "class='post share-enabled'", "class='form-factor'",
    "class='social-science'", "class='elementor-widget-container'", "class='legal-news'", "id='page-with-sidebar'", "class='sidebar'", "class='widget'", "class='notice'", "hidden",
    "style='display:none'", "role='dialog'",
]


@pytest.mark.parametrize("mark", WRAPPERS)
@pytest.mark.parametrize("tag", ["div", "section", "form"])
def test_wrappers_keep_the_article(mark, tag):
    page = f"<body>{NAV}<{tag} {mark}><h1>A crossing</h1>{BODY}<p>End.</p></{tag}><div class=sidebar><p>Other news, in brief.</p></div><footer>by us</footer></body>"
    assert htmltext.main_text(page) == f"A crossing\n{TEXT}\nEnd."


PAGES = {
    "replies beside": (f"<body>{NAV}<div><h1>A crossing</h1>{BODY}</div>{REPLIES}</body>", f"A crossing\n{TEXT}"),
    "replies within": (f"<body><div><h1>A crossing</h1>{BODY}<h2>After</h2><p>End.</p>{REPLIES}</div></body>", f"A crossing\n{TEXT}\nAfter\nEnd."),
    "notice within": (f"<body><div id=x>{BODY}<div>Cookies here</div><p>End.</p></div></body>", f"{TEXT}\nEnd."),
    "long marked comments": (
        f"<body><div><p>{PARAS[0]}</p><p>{PARAS[1]}</p></div><section id=comments>" + "".join(f"<div><p>{p}</p></div>" for p in PARAS * 6) + "</section></body>",
        f"{PARAS[0]}\n{PARAS[1]}",
    ),
    "only comments": (f"<body><div class=comments>{BODY}</div></body>", TEXT),
    "related work": (f"<article><h1>T</h1>{BODY}<section class='related-work'><h2>Related work</h2><p>{PARAS[0]}</p></section></article>", f"T\n{TEXT}\nRelated work\n{PARAS[0]}"),
    "link lists": (f"<body><div><div>{NAV}</div><div>{BODY}<ul><li>one thing<li>two</ul></div><div><a href=1>Next</a> <a href=2>Last</a></div></div></body>", f"{TEXT}\none thing\ntwo"),
    "sections": ("<div id=m>" + "".join(f"<section><h2>Part {k}</h2><p>{p}</p></section>" for k, p in enumerate(PARAS)) + "</div>", "\n".join(f"Part {k}\n{p}" for k, p in enumerate(PARAS))),
    "page in a form": (f"<form action=x><div>{NAV}</div><div>{BODY}</div><input value=z><button>Go</button></form>", TEXT),
    "header of the article": (f"<article><header class=entry-header><h1>T</h1><p>by A</p></header>{BODY}</article>", f"T\n{TEXT}"),
    "inline header": (f"<div><p><span class=header>Lead:</span> {PARAS[0]}</p>{BODY}</div>", f"Lead: {PARAS[0]}\n{TEXT}"),
    "a section named discussion": (f"<article><h1>T</h1>{BODY}<section id='discussion'><h2>Discussion</h2><p>{PARAS[0]}</p></section></article>", f"T\n{TEXT}\nDiscussion\n{PARAS[0]}"),
    "a section named search": (f"<main><h1>T</h1>{BODY}<section id='search'><h2>Search</h2><p>{PARAS[0]}</p></section></main>", f"T\n{TEXT}\nSearch\n{PARAS[0]}"),
    "a search box": (f"<main><h1>T</h1>{BODY}<div id='search'>Find it here</div><section id=comments><h2>Comments</h2><p>{PARAS[0]}</p></section></main>", f"T\n{TEXT}"),
    "a class marks": (f"<article><h1>T</h1>{BODY}<section class='discussion'><h2>Discussion</h2><p>{PARAS[0]}</p></section></article>", f"T\n{TEXT}"),
    "code within": (f"<div><p>{PARAS[0]}</p><div class='highlight'><pre>x = 1</pre></div><p>{PARAS[1]}</p><div><pre>y</pre></div><p>{PARAS[2]}</p></div>", f"{PARAS[0]}\nx = 1\n{PARAS[1]}\ny\n{PARAS[2]}"),
    "captions and intros": (f"<div><div class=intro>In short.</div><p>{PARAS[0]}</p><div class=cap>A boat</div><p>{PARAS[1]}</p></div>", f"In short.\n{PARAS[0]}\nA boat\n{PARAS[1]}"),
    "a table within": (f"<div><p>{PARAS[0]}</p><div><table><tr><td>a<td>1</table></div><p>{PARAS[1]}</p></div>", f"{PARAS[0]}\na\n1\n{PARAS[1]}"),
    "a closing list of links": (f"<body>{NAV}<div>{BODY}<ul><li><a href=x>Logbook</a><li><a href=y>Map</a></ul></div></body>", f"{TEXT}\nLogbook\nMap"),
    "a button in a sentence": (f"<div><p>{PARAS[0]}</p><p>{PARAS[1]} Press <button>OK</button> now.</p><form><label>Name</label><select><option>x<option>y</select></form></div>", f"{PARAS[0]}\n{PARAS[1]} Press now."),
    "> in a value": (f'<div title="a > b" data-x = "<p>"><p>{PARAS[0]}</p></div>', PARAS[0]),
    "stray quote": (f"<div \"><p class='>{PARAS[0]}</p><p>{PARAS[1]}</div>", f"{PARAS[0]}\n{PARAS[1]}"),
    "comment ends": (f"<!--> <!-- a > b --!><p>{PARAS[0]}<!-- x --> y</p><!-- {PARAS[1]}", f"{PARAS[0]} y"),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    source, want = PAGES[name]
    assert htmltext.main_text(source) == want


def test_the_ratios_decide(monkeypatch):
    """Without the scores, short unmarked replies and notices would be text."""
    monkeypatch.setattr(htmltext, "scores", lambda page: np.ones(len(page.blocks)))
    wrong = {name for name, (source, want) in PAGES.items() if htmltext.main_text(source) != want}
    assert {"replies beside", "replies within", "notice within"} <= wrong


def plain_scores(page):
    """The path ratios block by block and path by path."""
    of = [page.elements[b.element].path for b in page.blocks]
    paths = {p: [i for i, x in enumerate(of) if x == p] for p in of}

    def smoothed(values):
        ratio = {p: sum(values[i] for i in at) / len(at) for p, at in paths.items()}
        row = [ratio[p] for p in of]
        along = [sum(w * row[min(max(i + d, 0), len(row) - 1)] for d, w in zip((-2, -1, 0, 1, 2), (0.06, 0.24, 0.4, 0.24, 0.06), strict=True)) for i in range(len(row))]
        return {p: (ratio[p] * sum(along[i] for i in at) / len(at)) ** 0.5 for p, at in paths.items()}

    size = smoothed([b.unlinked for b in page.blocks])
    signs = smoothed([sum(c in ".,;:!?…。、，！？；：¿¡" for c in b.text) if b.unlinked else 0 for b in page.blocks])
    return [size[p] * (1 + signs[p]) * page.factors[p] for p in of]


def test_scores_equal_plain_loops(spark, sf):
    sources = [source for source, _ in PAGES.values()] + [r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").limit(40).collect()]
    for source in sources:
        page = htmltext.parse(source)
        assert np.allclose(htmltext.scores(page), plain_scores(page))
        score, size = plain_scores(page), [len(b.text) for b in page.blocks]
        inside = [i for i, b in enumerate(page.blocks) if not b.outside]
        mean = sum(score[i] * size[i] for i in inside) / sum(size[i] for i in inside)
        assert [i for i in inside if score[i] >= 0.25 * mean - 1e-9] == np.flatnonzero(htmltext.content(page)).tolist()


def hostile(n: int) -> dict[str, str]:
    return {
        "unclosed tags": "<a " * n, "unclosed tags, one end": "<a " * n + ">", "open values": "<a x='" * n, "odd values": "<a x=\">\" " * n, "two quotes": "<a b=\"'><a b='\">" * n,
        "unknown ends": "<div>" * 3000 + "</x>" * n, "inline ends": "<i><div>" + "<b>" * 3000 + "</i>" * n, "nested": "<div>" * n + "x" + "</div>" * n, "nested inline": "<b>x" * n,
        "rules": "<div>" + "<b>" * 3000 + "<hr>" * n, "items": "<li><ul>" + "<div>" * 3000 + "<li></li>" * n, "terms": "<div>" * 3000 + "<dd></dd>" * n, "comments": "<!--x-->" * n,
        "open comments": "<!--" * n, "unended": "<!" * n, "references": "&amp" * n, "paths": "".join(f"<div class=c{chr(97 + k % 26) * (1 + k // 26 % 50)}>x" for k in range(n)), "spaces": "<a" + " " * n + "b = " * 9 + ">",
        "scripts": "<script>x</script>" * n, "texts": "<title" * n, "texts, one end": "<title" * n + ">", "blocks": "<p>a, b. c" * n,
    }


@pytest.mark.parametrize("name", hostile(1))
def test_hostile_pages_take_time_in_proportion(name):
    took = {}
    for n in (10_000, 20_000, 40_000):
        began = time.process_time()
        htmltext.main_text(hostile(n)[name])
        took[n] = time.process_time() - began
    assert took[40_000] < 8 * max(took[10_000], 0.05), took


@pytest.mark.parametrize("name", ["nested", "nested inline", "paths", "inline ends"])
def test_memory_grows_with_the_page(name):
    peak = {}
    for n in (10_000, 40_000):
        source = hostile(n)[name]
        tracemalloc.start()
        htmltext.main_text(source)
        peak[n] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert peak[40_000] < 80 << 20 and peak[40_000] < 6 * peak[10_000], peak


def test_pages_of_every_kind_in_a_table(spark):
    shape = "row int, text string, html string, page_id long"
    rows = [(1, "t", PAGES["sections"][0], 1), (1, "t", PAGES["sections"][0], 1), (2, None, None, None), (None, "x", "", 3), (4, "y", "<p>" + PARAS[0] * 5000, 4)]
    df = spark.createDataFrame(rows, shape)
    got = htmltext.extracted(df.select(F.struct("row", "text", "page_id").alias("row"), "html")).collect()
    assert sorted((r["row"]["page_id"] or 0, r["text"]) for r in got) == sorted([(1, PAGES["sections"][1])] * 2 + [(0, ""), (3, ""), (4, PARAS[0] * 5000)])
    assert htmltext.extracted(df.limit(0).select(F.struct("row").alias("row"), "html")).collect() == []
