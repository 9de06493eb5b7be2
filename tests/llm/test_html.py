"""HTML extraction: what belongs to an article, and the path ratios against plain loops."""

from __future__ import annotations

import math
import random
import re

import pytest

from tabsieve.llm import html_extraction as H

TEXT = "This is a long paragraph, with several words; it has marks, too. And it goes on for a while, as text does."
P = f"<p>{TEXT}</p>"
PAGES = {
    "a teaser is no article": (f'<div class="content">{P * 3}</div><article><p>Read also this.</p></article>', [TEXT] * 3 + ["Read also this."]),
    "linked list and heading in an article": (f'<article>{P}<ul><li><a>First</a></li><li><a>Second</a></li></ul><h2><a href="#s">Part</a></h2>{P}</article>', [TEXT, "First", "Second", "Part", TEXT]),
    "linked list at the end of an article": (f"<article>{P}<ul><li><a>Source</a></li></ul></article>", [TEXT, "Source"]),
    "linked list between paragraphs of a div": (f'<div>{P}<ul><li><a>First</a></li></ul><h2><a>Part</a></h2>{P}</div><div><ul><li><a>Elsewhere</a></li></ul></div>', [TEXT, "First", "Part", TEXT]),
    "named menus go, also in an article": (f'<article>{P}<div class="related"><a>More</a></div><nav><a>Top</a></nav>{P}</article>', [TEXT, TEXT]),
    "title in a header of the article": (f'<article><div class="header"><h1>Title</h1></div>{P}</article>', ["Title", TEXT]),
    "title in a header element of the content": (f'<div class="content"><header><h1>Title</h1></header>{P * 2}</div>', ["Title", TEXT, TEXT]),
    "title in a post header": (f'<div class="content"><div class="post-header"><h1>Title</h1></div>{P * 2}</div>', ["Title", TEXT, TEXT]),
    "title before main": (f"<header><h1>Site</h1></header><h1>Title</h1><main>{P}</main>", ["Title", TEXT]),
    "no second title": (f"<h1>Site</h1><main><h1>Title</h1>{P}</main>", ["Title", TEXT]),
    "headers of the page go": (f'<body><header><h1>Site</h1></header><div class="header">Site</div><div>{P}</div><footer>Foot</footer></body>', [TEXT]),
    "menu in a header of the content": (f'<div class="content"><header><h1>Title</h1><nav><a>Top</a></nav></header>{P * 2}</div>', ["Title", TEXT, TEXT]),
}


@pytest.mark.parametrize("name", PAGES)
def test_what_belongs_to_the_content(name):
    page, expected = PAGES[name]
    assert H.main_text(page) == "\n".join(expected)


def ratios_by_hand(blocks):
    """Characters outside links and punctuation by path, smoothed, multiplied, averaged by path."""
    of = {}
    for b in blocks:
        of.setdefault(b.path, []).append(b)
    text = [sum(o.own for o in of[b.path]) / len(of[b.path]) for b in blocks]
    marks = [sum(len(re.findall(r"[.,;:!?…。，、；：！？·¿¡]", o.text)) * o.own / len(o.text) for o in of[b.path]) / len(of[b.path]) for b in blocks]

    def smooth(x, i):
        near = [(math.exp(-0.5 * d * d), x[i + d]) for d in range(-2, 3) if 0 <= i + d < len(x)]
        return sum(w * v for w, v in near) / sum(w for w, _ in near)

    fused = [smooth(text, i) * (1 + smooth(marks, i)) if text[i] else 0 for i in range(len(blocks))]
    return {p: sum(f for f, b in zip(fused, blocks) if b.path == p) / len(of[p]) for p in of}


def test_path_ratios_equal_plain_loops():
    rng = random.Random(9)
    for _ in range(60):
        page = "".join(f"<{t}>{rng.choice(['', '<a>link</a> '])}{'word, ' * rng.randint(0, 9)}</{t}>" for t in rng.choices(["p", "li", "h2", "div", "td", "blockquote"], k=rng.randint(1, 25)))
        blocks = H.blocks(f"<body><div>{page}</div></body>")
        if blocks:
            assert H.path_scores(blocks) == pytest.approx(ratios_by_hand(blocks))


def test_repeated_rows_nulls_and_names_of_results(spark):
    page = f"<article>{P}</article>"
    rows = [(1, page, "old", 5), (1, page, "old", 5), (2, None, "old", 5), (3, "", None, None)]
    frame = spark.createDataFrame(rows, "page_id long, html string, TEXT string, n_chars int")
    found = H.extract_text(frame)
    assert found.columns == ["page_id", "html", "text", "n_chars"] and dict(found.dtypes)["n_chars"] == "bigint"
    assert sorted((r.page_id, r.text, r.n_chars) for r in found.collect()) == [(1, TEXT, len(TEXT))] * 2 + [(2, "", 0), (3, "", 0)]
    assert H.extract_text(frame.limit(0)).count() == 0
