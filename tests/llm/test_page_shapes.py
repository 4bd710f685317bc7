"""Pages of shapes that no training page has, with their whole text."""

import random

import pyarrow.parquet as pq
import pytest

from textmill.llm import html_extraction

rng = random.Random(7)
VOCABULARY = "river stone window garden winter letter market silver morning teacher village bridge engine harbour mountain story music paper kitchen summer".split()


def line(n):
    words = [rng.choice(VOCABULARY) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def say(*sizes):
    return [line(n) for n in sizes]


def link(n):
    return f'<a href="/x">{line(n)}</a>'


NAV = "<nav><ul>" + "".join(f"<li>{link(1)}</li>" for _ in range(6)) + "</ul></nav>"
DIV_NAV = "<div><ul>" + "".join(f"<li>{link(1)}</li>" for _ in range(7)) + "</ul></div>"
FOOT = "<footer><p>Imprint and contact</p></footer>"
ASIDE = f"<aside class='sidebar'><h3>More</h3><ul>{''.join(f'<li>{link(3)}</li>' for _ in range(4))}</ul></aside>"


def shapes():
    """(name, page, blocks of text)."""
    t = say(5, 40, 30, 35)
    yield "plain article", f"<body>{NAV}<article><h1>{t[0]}</h1>{''.join(f'<p>{x}</p>' for x in t[1:])}</article>{FOOT}</body>", t
    t = say(5, 30, 8, 9, 7, 35)
    items = "".join(f"<li>{x}</li>" for x in t[2:5])
    yield "list", f"<body>{NAV}<article><h1>{t[0]}</h1><p>{t[1]}</p><ul>{items}</ul><p>{t[5]}</p></article>{FOOT}</body>", t
    t = say(5, 30, 2, 2, 3, 4, 35)
    rows = f"<table><tr><th>{t[2]}</th><th>{t[3]}</th></tr><tr><td>{t[4]}</td><td>{t[5]}</td></tr></table>"
    yield "table", f"<body>{NAV}<main><h1>{t[0]}</h1><p>{t[1]}</p>{rows}<p>{t[6]}</p></main>{FOOT}</body>", t
    t = say(6, 30, 4, 28, 5, 33, 4, 20)
    heads = "".join(f"<h{k}>{a}</h{k}><p>{b}</p>" for k, (a, b) in zip((2, 3, 4), zip(t[2::2], t[3::2])))
    yield "headings", f"<body>{NAV}<article><h1>{t[0]}</h1><p>{t[1]}</p>{heads}</article>{FOOT}</body>", t
    t = say(6, 12, 30, 28)
    yield "header in the article", f"<body><header class='site'><p>Daily paper</p></header>{NAV}<article><header><h1>{t[0]}</h1><p>{t[1]}</p></header><p>{t[2]}</p><p>{t[3]}</p></article>{FOOT}</body>", t
    t = say(5, 28, 25, 30, 10, 31)
    yield "quote and caption", f"<body>{NAV}<article><h1>{t[0]}</h1><p>{t[1]}</p><blockquote><p>{t[2]}</p></blockquote><p>{t[3]}</p><figure><img src=x><figcaption>{t[4]}</figcaption></figure><p>{t[5]}</p></article>{FOOT}</body>", t
    t = say(5, 28, 30, 26)
    yield "code", f"<body>{NAV}<article><h1>{t[0]}</h1><p>{t[1]}</p><pre>{t[2]}</pre><p>{t[3]}</p></article>{FOOT}</body>", t
    t = say(5, 28, 2, 15, 2, 14, 26)
    yield "definitions", f"<body>{NAV}<article><h1>{t[0]}</h1><p>{t[1]}</p><dl><dt>{t[2]}</dt><dd>{t[3]}</dd><dt>{t[4]}</dt><dd>{t[5]}</dd></dl><p>{t[6]}</p></article>{FOOT}</body>", t
    t = say(6, 35, 40, 30, 45)
    yield "plain divs", f"<body>{DIV_NAV}<div><h1>{t[0]}</h1>{''.join(f'<p>{x}</p>' for x in t[1:])}</div><div><ul><li>{link(2)}</li><li>{link(2)}</li><li>{link(1)}</li></ul></div></body>", t
    t = say(6, 35, 8, 9, 30, 5, 45)
    body = f"<h1>{t[0]}</h1><p>{t[1]}</p><ul><li>{t[2]}</li><li>{t[3]}</li></ul><p>{t[4]}</p><h2>{t[5]}</h2><p>{t[6]}</p>"
    yield "plain divs, list and heading", f"<body>{DIV_NAV}<div><div>{body}</div></div><div><ul><li>{link(2)}</li><li>{link(2)}</li><li>{link(1)}</li></ul></div></body>", t
    t = say(5, 40, 30, 35)
    replies = "".join(f"<div class='reply'><p>{line(18)}</p></div>" for _ in range(3))
    yield "replies", f"<body>{NAV}<article><h1>{t[0]}</h1>{''.join(f'<p>{x}</p>' for x in t[1:])}</article><section id='responses'>{replies}</section>{FOOT}</body>", t
    t = say(5, 40, 30, 35)
    yield "sidebar, notice, form", f"<body><div class='cookie notice'><p>{line(14)}</p></div>{NAV}{ASIDE}<main><h1>{t[0]}</h1>{''.join(f'<p>{x}</p>' for x in t[1:])}</main><form><label>Your name</label><button>Send</button></form>{FOOT}</body>", t
    t = say(5, 30, 4, 33, 25)
    yield "sections", f"<body>{NAV}<main><h1>{t[0]}</h1><section><p>{t[1]}</p></section><section><h2>{t[2]}</h2><p>{t[3]}</p><p>{t[4]}</p></section></main>{FOOT}</body>", t
    t = say(5, 40, 30, 35)
    yield "advert inside", f"<body>{NAV}<article><h1>{t[0]}</h1><p>{t[1]}</p><div class='advert'><p>{line(12)}</p></div><p>{t[2]}</p><p>{t[3]}</p></article>{FOOT}</body>", t


@pytest.fixture(scope="module")
def model():
    pages = pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["html"])["html"].to_pylist()
    return html_extraction.train(sorted(pages[:400]))


def test_pages_of_other_shapes(model):
    found = wanted = right = 0
    report = []
    for _ in range(5):
        for name, page, want in shapes():
            got = html_extraction.main_text(model, [page])[0].split("\n\n")
            hit = sum(x in want for x in got)
            found, wanted, right = found + len(got), wanted + len(want), right + hit
            if got != want:
                report.append((name, [x for x in want if x not in got], [x for x in got if x not in want]))
    assert len({name for name, _, _ in shapes()}) >= 12
    assert right / wanted >= 0.98 and right / found >= 0.98, (right / wanted, right / found, report)


def test_given_pages_as_their_tags_say(model):
    pages = pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["html"])["html"].to_pylist()[1000:1400]
    cut = [html_extraction.blocks(p) for p in pages]
    want = ["\n\n".join(b.text for b, yes in zip(p, html_extraction.taught(p)) if yes) for p in cut]
    got = html_extraction.main_text(model, pages)
    assert sum(a == b for a, b in zip(got, want)) >= 0.995 * len(pages)
