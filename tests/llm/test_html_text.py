"""Main text of pages whose truth is known: equal lines, short parts of a story, and random pages with marked lines."""

import random

import pytest

from billproof.llm import html_text

STORY = "".join(f"<p>Paragraph {i} of the story, which is long enough to tell what has happened and to whom it did.</p>" for i in range(6))
TOLD = " ".join(f"Paragraph {i} of the story, which is long enough to tell what has happened and to whom it did." for i in range(6))


@pytest.mark.parametrize("tag, item", [("article", "p"), ("ul", "li"), ("div", "p"), ("main", "div"), ("table", "td")])
def test_equal_lines_of_any_number_and_length(tag, item):
    for k in [*range(1, 25), 60]:
        for length in [*range(1, 30), 100, 997]:
            line = ("ab cd " * length)[:length].strip() or "x"
            page = f"<{tag}>" + f"<{item}>{line}</{item}>" * k + f"</{tag}>"
            assert html_text.main_text(page) == " ".join([line] * k)


def test_lines_that_differ_in_the_last_bits():
    for page in ("<article><p>abc def</p><p>ghi jkl</p><p>mno pqr</p></article>", "<ul>" + "".join(f"<li>item {i}</li>" for i in range(5)) + "</ul>"):
        assert html_text.main_text(page)
    assert html_text.threshold([1.0, 1.0 + 2**-52, 1.0]) <= 1.0 + 2**-52


@pytest.mark.parametrize(
    "part, text",
    [
        ("<section><h2>Result</h2><p>They won.</p></section>", "Result They won."),
        ("<div><p>Nobody was hurt.</p></div>", "Nobody was hurt."),
        ("<blockquote>So it goes.</blockquote>", "So it goes."),
        ("<ul><li>One</li><li>Two</li></ul>", "One Two"),
        ("<table>" + "".join(f"<tr><td>{d}</td></tr>" for d in range(1990, 1997)) + "</table>", " ".join(map(str, range(1990, 1997)))),
        ('<div class="related-work"><p>Others did this before.</p></div>', "Others did this before."),
        ('<div class="share-price"><p>It fell by 3.</p></div>', "It fell by 3."),
        ('<div class="related-posts"><p>More like this</p></div>', ""),
        ('<div id="cookieNotice"><p>We use them</p></div>', ""),
        ('<div class="ad-300x250">Buy now</div>', ""),
        ('<div class="newsletter__signup-form">Join</div>', ""),
        ('<aside><p>Side</p></aside>', ""),
    ],
)
def test_short_parts_of_a_story(part, text):
    want = f"{TOLD} {text}".strip()
    assert html_text.main_text(f"<body><article>{STORY}{part}</article></body>") == want
    assert html_text.main_text(f"<body><main>{STORY}{part}</main><footer>Foot</footer></body>") == want
    assert html_text.main_text(f"<body><nav>Menu</nav><div>{STORY}{part}</div></body>") == want


def test_boxes_around_and_beside_the_story():
    wrapped = f"<body><div><div class='teaser'>Cats. Dogs.</div><div><h1>Title</h1><div>{STORY}</div></div><div>Short.</div></div></body>"
    assert html_text.main_text(wrapped) == "Title " + TOLD
    sections = "".join(f"<section>{STORY}</section>" for _ in range(3))
    assert html_text.main_text(f"<body><div>{sections}<section><p>The end.</p></section></div></body>") == " ".join([TOLD] * 3) + " The end."
    both = f"<body><article>{STORY}</article><div>Between.</div><article>{STORY}</article></body>"
    assert html_text.main_text(both) == f"{TOLD} {TOLD}"
    assert html_text.main_text("<body><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></body>") == ""


WORDS = "the of and river stone house light under open water again seven morning".split()


def sentence(rng, low, high):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high))) + "."


def random_page(rng):
    """(page, its story) with boilerplate of every kind around and inside."""
    told = []

    def said(tag, low=3, high=40):
        text = sentence(rng, low, high)
        told.append(text)
        words = text.split()
        at = rng.randrange(len(words))
        words[at] = rng.choice(["<b>{}</b>", "<i>{}</i>", "<a href=x>{}</a>" if len(words) > 1 else "{}", "{}"]).format(words[at])
        return f"<{tag}>" + rng.choice([" ", "\n", "  "]).join(words) + rng.choice([f"</{tag}>", f"</{tag}>\n"])

    def noise():
        return rng.choice([
            f"<aside>{sentence(rng, 2, 30)}</aside>", f"<div class='ad-slot'>{sentence(rng, 2, 20)}</div>", f"<form><p>{sentence(rng, 2, 9)}</p><button>Go</button></form>",
            f"<script>var a = '{sentence(rng, 2, 5)}</p>';</script>", f"<!-- {sentence(rng, 2, 5)} -->", f"<div class='share social'><a href=x>{sentence(rng, 1, 3)}</a></div>", "",
        ])

    def part():
        kind = rng.randrange(6)
        if kind == 0:
            return "<section>" + said("h2", 1, 3) + said("p") + "</section>"
        if kind == 1:
            return "<ul>" + "".join(said("li", 1, 6) for _ in range(rng.randint(1, 4))) + "</ul>"
        if kind == 2:
            return "<blockquote>" + said("p", 2, 9) + "</blockquote>"
        if kind == 3:
            return "<table><tr>" + said("td", 1, 3) + said("td", 1, 3) + "</tr></table>"
        return said("p")

    inner = "".join(part() + noise() for _ in range(rng.randint(1, 12)))
    tag = rng.choice(["article", "main", "main"])
    story = inner
    boxed = f"<{tag}>{story}</{tag}>" if rng.random() < 0.7 else f"<{tag}><div>{story}</div></{tag}>"
    menu = "<nav><ul>" + "".join(f"<li><a href=x>{sentence(rng, 1, 2)}</a></li>" for _ in range(rng.randint(1, 8))) + "</ul></nav>"
    comments = "<section class='comments'>" + "".join(f"<p>{sentence(rng, 3, 40)}</p>" for _ in range(rng.randint(0, 6))) + "</section>"
    page = f"<html><head><title>{sentence(rng, 1, 4)}</title></head><body><header>{sentence(rng, 1, 9)}</header>{menu}{noise()}{boxed}{noise()}{comments}<footer>{sentence(rng, 1, 30)}</footer></body></html>"
    return page, " ".join(told)


def test_random_pages():
    for seed in range(600):
        page, told = random_page(random.Random(seed))
        assert html_text.main_text(page) == told, seed


def test_no_rows_and_clashing_columns(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, title int"
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "u", "<article><p>One</p></article>", "old", "x", 3), (1, "u", None, None, None, None), (None, None, "<p>" + "word " * 40000, "", "", 1)]
    found = [tuple(r) for r in html_text.extract(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(found, key=repr) == sorted([(1, "u", "One", 3), (1, "u", "", 0), (None, None, ("word " * 40000).strip(), 199999)], key=repr)


def test_sf_pages_give_their_article(spark, sf):
    """The test pages hold one article each; its text without markup is the truth."""
    import re
    from html import unescape

    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        inner = re.sub(r"<(script|style|aside|form)\b.*?</\1>|<!--.*?-->", " ", inner, flags=re.S)
        plain = re.sub(r"</?(?:b|i|em|strong|a|span)\b[^>]*>", "", inner)
        plain = unescape(re.sub(r"<[^>]*>", " ", plain))
        assert html_text.main_text(r.html) == " ".join(plain.split()), r.page_id
