"""Main text of broken, oddly named and unnamed pages."""

from __future__ import annotations

import time

import pytest

from caudal.llm import blocks

TREE = blocks.grow()
LONG = " ".join(f"word{i}" for i in range(40))
BODY = f"<h1>A title of it</h1><p>{LONG}</p><p>Short one.</p>"
TEXT = f"A title of it\n\n{LONG}\n\nShort one."


def text(page):
    return blocks.main_text(page, TREE)


@pytest.mark.parametrize("page", [
    '<div class="page has-sidebar"><article>{}</article></div>',
    '<main class="no-sidebar">{}</main>',
    '<article class="post tag-print">{}</article>',
    '<div id="search-results"><article>{}</article></div>',
    '<form id="aspnetForm"><article>{}</article></form>',
    '<div class="sidebar-layout menu"><article>{}</article></div>',
    '<article title="hidden" data-x="class=ad">{}</article>',
    '<div title="nothing hidden here"><article>{}</article></div>',
    '<article data-html="<div class=\'ad\'>">{}</article>',
    "<div hidden>x y z</div><article>{}</article><div class='a b' style='display : none'>no</div>",
    '<ul class="main-menu"><li>x</ul><div class="cookie-banner">we use many cookies here and there</div><article>{}</article>',
    '<article><section class="comment-list"><p>a reader says a lot of things here and there</section>{}</article>',
    '<article>{}</article><div id="comments"><article><p>' + LONG + "</article></div>",
    "<aside><article><p>" + LONG + "</article></aside><article>{}</article>",
])
def test_names_around_and_on_the_article(page):
    assert text(page.format(BODY)) == TEXT


@pytest.mark.parametrize("page, wanted", [
    (f"<article><p>{LONG}<button>Share<p>after</article>", f"{LONG}\n\nafter"),
    (f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</article>", f"{LONG} x=1 holds"),
    (f"<article><p>{LONG}<p>See<ol><li><a href=x>The first of the references</a><li><a href=y>Another one of them here</a></ol></article>",
     f"{LONG}\n\nSee\n\nThe first of the references\n\nAnother one of them here"),
    (f'<article><p title="never closed>{LONG}</p><p>more</article>', f"{LONG}\n\nmore"),
    (f"<article><p title='a>b' class=\"x\">{LONG}</p><p>1 < 2 and <b more</article>", f"{LONG}\n\n1 < 2 and"),
    (f"<article><p>{LONG}<script>if (a < b) {{ '</p>' }}</script> on<textarea>no</textarea></article>", f"{LONG} on"),
    (f"<article><title>{LONG}<p>x</article>", f"{LONG}\n\nx"),
    ("plain text alone", "plain text alone"), ("", ""), ("<", "<"), ("a < b", "a < b"), ("<!-- <article>x</article>", ""),
])
def test_broken_and_odd_pages(page, wanted):
    assert text(page) == wanted


def test_a_form_around_the_page_and_a_form_in_it():
    assert text(f"<form id=f><div><p>{LONG}<p>{LONG} again</div></form>") == f"{LONG}\n\n{LONG} again"
    assert text(f"<article><p>{LONG} and {LONG}</article><form><p>Your name and your mail address and what you want to say</form>") == f"{LONG} and {LONG}"


@pytest.mark.parametrize("piece", [
    "<a ", '<a b="', "<a b='x\" ", "<div>", "<", "<!--", "<title>", "</p", "<p a=\"<p a='", "<button>", "&amp", "<script ", "<li></ul>", "<x y=z ",
])
def test_broken_pages_of_a_megabyte_end(piece):
    page = piece * (1_000_000 // len(piece))
    start = time.process_time()
    text(page)
    text("<article><p>" + page)
    assert time.process_time() - start < 6


def test_articles_of_any_shape():
    """Whatever the lengths of its paragraphs and what stands before and after it, an article is kept whole and nothing else is."""
    import random

    random.seed(5)
    words = lambda n: " ".join(f"w{random.randrange(10**6)}" for _ in range(n))
    around = ["<nav><ul><li><a>{}</a></ul></nav>", "<div class=ad>{}</div>", "<footer>{}</footer>", "<div class=comments><p>{}</div>", "<aside>{}</aside>", ""]
    for _ in range(400):
        parts = [words(random.choice((1, 2, 3, 5, 9, 30, 100))) for _ in range(random.randint(1, 9))]
        before, after = (random.choice(around).format(words(random.choice((1, 4, 30, 90)))) for _ in range(2))
        assert text(before + "<article>" + "".join(f"<p>{x}" for x in parts) + "</article>" + after) == "\n\n".join(parts)


def test_pages_without_an_article():
    """Recall and precision of words on pages that name nothing: links, lengths and neighbours have to tell."""
    import random

    random.seed(8)
    words = lambda n: " ".join(f"w{random.randrange(10**6)}" for _ in range(n))
    right = kept = wanted = 0
    for _ in range(200):
        parts, main = [], []
        parts += [f"<div><a href=x>{words(random.randint(1, 3))}</a></div>" for _ in range(random.randint(3, 9))]
        for _ in range(random.randint(3, 12)):
            if random.random() < 0.15:
                main.append(words(random.randint(3, 7)))
                parts.append(f"<h2>{main[-1]}</h2>")
            main.append(words(random.randint(25, 90)))
            parts.append(f"<div>{main[-1]}</div>")
        parts += [f"<li><a href=y>{words(random.randint(2, 8))}</a></li>" for _ in range(random.randint(2, 8))] + [f"<div>{words(random.randint(3, 6))}</div>"]
        found = set(text("".join(parts)).split())
        all_main = set(" ".join(main).split())
        right, kept, wanted = right + len(found & all_main), kept + len(found), wanted + len(all_main)
    assert right / wanted > 0.95 and right / kept > 0.98


def test_the_tree_asks_for_words_links_and_neighbours():
    def asked(node):
        return set() if node.feature < 0 else {blocks.FEATURES[node.feature]} | asked(node.left) | asked(node.right)

    assert {"words", "links", "outside", "inside"} <= asked(TREE) and asked(TREE) & {"words_before", "words_after", "links_before", "links_after"}
    table = blocks.labelled()
    assert sum(TREE.tell(r[:-1]) == bool(r[-1]) for r in table) / len(table) > 0.98
