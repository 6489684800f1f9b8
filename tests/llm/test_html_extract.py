from __future__ import annotations

import html
import random
import re
import time

import pytest
from lexmill.llm.html_extract import extract, main_text

LONG = "A long sentence of the story that goes on and on, with commas and clauses, until it ends. " * 4


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("", ""),
        ("plain text only", "plain text only"),
        ("<p>a &amp; b&nbsp;&eacute;&#8364;<br>c\n\t d</p>", "a & b é€ c d"),
        ("<nav>menu</nav><header>site</header><footer>foot</footer>", ""),
        (f"<article><header><h1>Head</h1><a>share</a></header><p>{LONG}</p><p>End.</p></article>", f"Head {LONG.strip()} End."),
        (
            f"<body><div class='sidebar'><p>{LONG}</p></div><div id='content'><h1>T</h1><p>{LONG}<p>Short.</div>"
            f"<section id='comments'><p>{LONG}</p></section><div class='cookie-notice'>ok?</div></body>",
            f"T {LONG.strip()} Short.",
        ),
        (f"<main><p>{LONG}<p>x<form><input><p>mail</p></form><aside>{LONG}</aside></main><!-- {LONG} -->", f"{LONG.strip()} x"),
        (f"<article><p><b>{LONG}<br><p>two</article><footer>f", f"{LONG.strip()} two"),
        (f"<script>var t='</p>';</script><style>p{{}}</style><article><p>{LONG}</p>cut <b", f"{LONG.strip()} cut"),
        (f"<div class=post><ul><li>{LONG}<li>item</ul><pre>code  x</pre></div><div role='contentinfo'>c</div>", f"{LONG.strip()} item code x"),
        (f"<article><p>{LONG}</p><div class='ad'>buy</div><p>in<i>line</i>s</p><p hidden>no</p></article>", f"{LONG.strip()} inlines"),
    ],
)
def test_pages(page, expected):
    assert main_text(page) == expected


def test_invented_pages_give_their_article():
    draw = random.Random(11)
    for _ in range(200):
        texts = [" ".join("abc&<é"[draw.randrange(6)] * draw.randrange(1, 5) for _ in range(draw.randrange(1, 60))) for _ in range(draw.randrange(1, 9))]
        inner = "".join(f"<p>{html.escape(text)}</p>" for text in texts)
        tag = draw.choice(["article", "main", "div id=content"])
        page = f"<html><head><title>t</title></head><body><nav><ul>{'<li><a href=x>m</a></li>' * 6}</ul></nav>" \
            f"<div class=ad>{html.escape(texts[0])}</div><{tag}><h1>Head</h1>{inner}</{tag.split()[0]}><footer>f &copy;</footer></body></html>"
        assert main_text(page) == re.sub(r"\s+", " ", " ".join(["Head", *texts]))


def test_rows(spark):
    rows = [(1, "u", f"<article>{LONG * 3000}</article>", 1), (2, None, None, 2), (None, "v", "<p>x</p>", 3), (None, "v", "<p>x</p>", 3)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")).collect()
    by_id = {row.page_id: row for row in got}
    assert len(got) == 4 and by_id[2].text == "" and by_id[2].n_chars == 0 and by_id[None].text == "x"
    assert by_id[1].n_chars == len((LONG * 3000).strip())
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (f"<html><head><title>t</title><meta charset=x><body><article><p>{LONG}</p></article></body></html>", LONG.strip()),
        (f"<html><head><title>t</title></head><article><p>{LONG}</p></article></html>", LONG.strip()),
        (f"<head><title>t</title><link href=x><p>{LONG}<p>End.", f"{LONG.strip()} End."),
        (f"<head><title>t</title><style>p{{}}</style> {LONG}", LONG.strip()),
        (f"<head><noscript><img src=x><p>no</noscript><script>s</script><body><p>{LONG}", LONG.strip()),
        (f"<head><title>t</title><noscript><p>no<body><p>{LONG}", LONG.strip()),
    ],
)
def test_pages_that_leave_out_tags_around_head_and_body(page, expected):
    assert main_text(page) == expected


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (f"<article><p>{LONG}</p><p class='tags-explained legal'>kept</p><div class='search-results'><p>found</p></div></article>", f"{LONG.strip()} kept found"),
        (f"<article><p>{LONG}</p><div class='share-buttons'>s</div><div class='inline-ad box'>b</div><p class='notice'>n</p></article>", LONG.strip()),
        (f"<div class='search-results'><p>{LONG}</p></div><article><p>{LONG}</p></article>", LONG.strip()),
        (f"<article><p>{LONG}</p></article><nav>m</nav><article><h2>Two</h2><p>{LONG}</p></article>", f"{LONG.strip()} Two {LONG.strip()}"),
        (f"<main><h1>H</h1><article><p>{LONG}</p></article><article><p>{LONG}</p></article></main>", f"{LONG.strip()} {LONG.strip()}"),
        (f"<article><p>{LONG}</p></article><article class='comment'><p>{LONG}</p></article>", LONG.strip()),
        (f"<article><p>{LONG}</p></article><aside><article><p>{LONG}</p></article></aside>", LONG.strip()),
    ],
)
def test_names_inside_an_article_and_further_articles(page, expected):
    assert main_text(page) == expected


@pytest.mark.parametrize("opened", ["<div>", "<ul><li>", "<b>", "<dl><dd><div>", "<p><i>", "<section></div>", "<main><u>"])
def test_depth_costs_no_more_than_length(opened):
    count = 20_000
    started = time.process_time()
    text = main_text(opened * count + "text <dd></dd></u></p>" * count)
    assert text.split() == ["text"] * count
    assert time.process_time() - started < 10  # a walk to the top for each tag takes minutes
