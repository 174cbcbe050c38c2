from __future__ import annotations

import itertools
import random

from conftest import SF_SMALL

from eventide.llm import html_cut as hc
from eventide.llm.common import table


def cost(excess, edges, side):
    return (sum(max(-e, 0) if s else max(e, 0) for e, s in zip(excess, side))
            + sum(w for a, b, w in edges if side[a] != side[b]))


def test_cut_is_the_cheapest_labelling():
    r = random.Random(2)
    for _ in range(300):
        n = r.randrange(1, 8)
        excess = [r.choice([-8, -3, -1, -0.4, 0, 0.4, 1, 3, 6]) for _ in range(n)]
        edges = [(a, b, r.choice([0.3, 0.6, 0.9, 2])) for a in range(n) for b in range(a)
                 if r.random() < 0.5]
        side = hc.source_side(excess, edges)
        best = min(cost(excess, edges, s) for s in itertools.product([False, True], repeat=n))
        assert abs(cost(excess, edges, side) - best) < 1e-9


def text(page):
    return hc.main_text(page, hc.PRIOR)


def test_article_without_furniture():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style>
      <script>var t="</p>";</script></head><body><header><h1>Site</h1><nav><ul><li><a href="/">Home</a>
      </li><li>About</li></ul></nav></header><div class="cookie-notice"><p>We use cookies, and more.</p></div>
      <!-- <p>hidden</p> --><article><header><h1>Title &amp; more</h1></header><p>First <b>bold</b>
      para,\n with&nbsp;space.<p>Second para. It goes on, with words.<br>Same block.</p>
      <div class="ad">Buy now, it is cheap and good.</div><ul><li>An item of the article.</li></ul>
      <form><p>Subscribe now, please do.</p></form></article><aside><p>Related: other things.</p></aside>
      <section id="comments"><p>I think that this is wrong, said a reader.</p></section>
      <footer><p>&copy; Someone, all rights.</p></footer></body></html>"""
    assert text(page) == ("Title & more\nFirst bold para, with space.\n"
                          "Second para. It goes on, with words. Same block.\nAn item of the article.")


def test_page_without_semantic_markup():
    para = "This is a longer paragraph of the story, with sentences. It has commas, and ends."
    links = "".join(f'<li><a href="/{k}">link {k}</a></li>' for k in range(6))
    page = f"<body><div><ul>{links}</ul></div><div><h2>Head</h2>" + f"<p>{para}</p>" * 4 + \
        f"</div><div><ul>{links}</ul></div></body>"
    assert text(page) == "\n".join(["Head"] + [para] * 4)


def test_smoothing_keeps_a_short_block_between_long_ones():
    para = "<p>This is a longer paragraph of the story, with sentences. It has commas, and ends.</p>"
    assert "Yes." in text(f"<div>{para}{para}<p>Yes.</p>{para}{para}</div>")


def test_broken_pages():
    assert text("") == ""
    assert text("<article><p>cut off in a ta</p><p>next, one.</p></artic") == "cut off in a ta\nnext, one."
    assert text("<article><p>a &am") == "a &am"
    assert text("<article><p>one, two. <a href=\"x>y\">z</a> three.</p>") == "one, two. z three."
    assert text("<article><p>1 < 2 and 3 > 2, so.</p></article>") == "1 < 2 and 3 > 2, so."
    assert text("<article><script>never closed") == ""
    assert text("<article><p>" + "word, and word. " * 20000).count("word") == 40000
    assert text("<article>" + "<div>" * 3000 + "deep, text. here" + "</div>" * 3000) == "deep, text. here"


def test_odd_rows_and_clashing_columns(spark):
    page = "<article><p>Text, with words.</p></article>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "u", page), (3, "v", "")]
    df = spark.createDataFrame([(*r, "t", 1, "i") for r in rows],
                               "page_id long, url string, html string, text string, n_chars int, id string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in hc.extract(df).collect()), key=str)
    want = "Text, with words."
    assert got == sorted([(1, "u", want, 17)] * 2 + [(2, None, "", 0), (None, "u", want, 17),
                                                     (3, "v", "", 0)], key=str)
    assert hc.extract(df.limit(0)).count() == 0


def test_given_pages_give_their_article(spark):
    import html
    import re
    pages = table(spark, SF_SMALL, "pages")
    out = {r.page_id: r.text for r in hc.extract(pages).collect()}
    for r in pages.collect():
        body = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1])
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", body))
        assert out[r.page_id] == "\n".join(b for b in blocks if b)


PARA = "This is a longer paragraph of the story, with sentences. It has commas, and ends."


def test_class_words_of_a_wrapper_do_not_drop_the_article():
    links = "".join(f'<li><a href="/{k}">link {k}</a></li>' for k in range(6))
    want = "\n".join(["A headline of five words"] + [PARA] * 3)
    for marks in ('class="content has-sidebar"', 'id="no-sidebar"', 'class="header-fixed"',
                  'class="sidebar content"', 'class="hasSidebar"'):
        for inner in ('', 'class="entry-content"'):
            page = (f"<body><ul>{links}</ul><div {marks}><div {inner}><h2>A headline of five words</h2>"
                    + f"<p>{PARA}</p>" * 3 + f'</div></div><div class="sidebar"><ul>{links}</ul></div></body>')
            assert text(page) == want, (marks, inner)

    head = "A headline of as many words as usual"
    for page in ("<body><div class=widget-layout>%s</div></body>",
                 "<article><div class=share-layout>%s</div></article>"):
        story = f"<h2>{head}</h2>" + f"<p>{PARA} {PARA}</p>" * 3
        assert text(page % story) == "\n".join([head] + [f"{PARA} {PARA}"] * 3)


def test_header_class_inside_an_article_keeps_the_headline():
    page = f"""<article><header class="entry-header"><h1>Title</h1></header><p>{PARA}</p>
      <div class="share"><a href="/s">Share this</a></div></article>"""
    assert text(page) == f"Title\n{PARA}"
    page = f"""<main><div class="page-header"><h1><a href="/">Title</a></h1></div><p>{PARA}</p></main>"""
    assert text(page) == f"Title\n{PARA}"


def test_comments_beside_an_article_stay_out():
    page = f"""<article><h1>Title</h1><p>{PARA}</p></article><div id="comments"><p>{PARA}</p><p>{PARA} {PARA}
      </p></div>"""
    assert text(page) == f"Title\n{PARA}"
    page = f"""<div class="post"><h1>Title</h1><p>{PARA}</p></div><div id="comments"><div class="comment">
      <div class="comment-content"><p>{PARA}</p></div></div></div>"""
    assert text(page) == f"Title\n{PARA}"


def test_letters_are_counted_over_the_whole_block():
    mixed, = hc.features(hc.page_blocks("<p>" + "1" * 200 + "a" * 600 + "</p>"))
    assert mixed[hc.FEATURES.index("letters")] == 0.75


def test_embedded_elements_end_with_their_parent_and_formulas_stay():
    for tag in "button select svg object iframe canvas audio video noscript template".split():
        article = f"<article><p>{PARA}</p>%s<p>{PARA}</p></article>"
        for inner in ("", "words", "<p>words", "<p>words</p>", "<b>a</b><i/>"):
            assert text(article % f"<{tag} a=b>{inner}</{tag}>") == f"{PARA}\n{PARA}", (tag, inner)
        assert text(article % f"<div><{tag}></div>") == f"{PARA}\n{PARA}"
        assert text(article % f"<{tag}>") == f"{PARA}\n{PARA}"
        assert text(f"<article><p>one, <{tag}><p>{PARA}</p></article><p>x").endswith(PARA)
    assert text(f"<article><button>Share<p>{PARA}</p><button>Like</button></article>") == PARA
    assert text("<article><p>As <svg><text>no</text></svg>is, two.</p></article>") == "As is, two."
    assert text("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math>"
                " holds, always.</p></article>") == "So x=1 holds, always."


def test_a_wrapper_around_the_page_says_nothing():
    links = "".join(f'<li><a href="/{k}">link {k}</a></li>' for k in range(6))
    story = "<h1>A headline of five words</h1>" + f"<p>{PARA}</p>" * 3
    want = "\n".join(["A headline of five words"] + [PARA] * 3)
    for wrapper in ("form", "fieldset", "dialog", "div role=status", "div role='form'",
                    "section role=note", "div role=dialog"):
        end = wrapper.split()[0]
        page = (f"<body><{wrapper}><nav><ul>{links}</ul></nav><div>{story}</div><div><ul>{links}</ul>"
                f"</div><footer><p>{PARA}</p></footer></{end}></body>")
        assert text(page) == want, wrapper
    # inside such a form, a smaller one is furniture still, and so is one beside the story
    small = f"<div role=dialog><p>{PARA}</p></div>"
    assert text(f"<form>{small}<div>{story}</div></form>") == want
    for one in (small, f"<form><p>{PARA}</p></form>", f"<fieldset><p>{PARA}</p></fieldset>"):
        assert text(f"<body><div>{story}</div>{one}</body>") == want, one
    assert text("<form><p>User</p><input><p>Password</p><input><p>Log in to go on.</p></form>") == ""


def test_comments_beside_prose_stay_out_without_article_or_main():
    said = f"<p>{PARA}</p>" * 5
    for name in ('class="comments"', 'id="comments"', 'class="comment-list"', 'id="disqus_thread"'):
        for entry in ('<div class="entry">%s</div>', "<div>%s</div>", "<form><div>%s</div>"):
            page = f"<body>{entry % f'<h1>Title</h1><p>{PARA}</p>'}<div {name}>{said}</div></body>"
            assert text(page) == f"Title\n{PARA}", (name, entry)
    # comments that are articles of their own
    page = f"""<article><h1>Title</h1><p>{PARA}</p></article><ol class="commentlist"><li>
      <article class="comment-body"><p>{PARA}</p><p>{PARA}</p></article></li></ol>"""
    assert text(page) == f"Title\n{PARA}"
    page = f"""<main><p>{PARA}</p><section class="comments"><article><p>{PARA}</p></article></section></main>"""
    assert text(page) == PARA
    # a page of nothing else keeps what prose outweighs; a page that only mentions them, all
    assert text(f'<div class="comments"><p>{PARA} {PARA}</p><p>{PARA} {PARA}</p></div>') != ""
    assert text(f'<div class="has-comments"><h1>Title</h1><p>{PARA}</p><p>{PARA}</p></div>') == \
        f"Title\n{PARA}\n{PARA}"
