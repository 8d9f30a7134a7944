import random
import time

import pytest

from clickmill.llm.page_tree import MOST, _pairs, align, blocks, expression, parse


def shared(pages):
    wrapper = expression(parse(pages[0]))
    for page in pages[1:]:
        wrapper = align(wrapper, expression(parse(page)))
    return wrapper


@pytest.mark.parametrize("page", [
    "<a " * 1_700_000, "<a " * 300_000 + "<!", "<a \"" * 250_000 + ">x", "<a 'x\"y " * 120_000 + ">x", "<b>" * 160_000 + "<div></div>" * 45_000,
    "<b>" * 160_000 + "</i>" * 120_000, "<b>x</b>" * 120_000, "<nav>" * 100_000, "<ul><li><ul>" + "<div>" * 1000 + "<li></li>" * 110_000,
    "<" * 1_000_000, "<script>" + "</script" * 120_000, "<!--" * 250_000, "a < b " * 160_000 + ">",
], ids=range(13))
def test_long_pages_take_linear_time(page):
    start = time.process_time()
    tree = parse(page)
    blocks(tree, expression(tree), True)
    assert time.process_time() - start < 30


def test_many_varied_siblings():
    rng = random.Random(1)

    def page(n):
        return "<article>" + "".join(f'<div class="{"".join(rng.choices("abcdefgh", k=5))}">t{i}</div>' for i in range(n)) + "</article>"

    start = time.process_time()
    one, two = page(20_000), page(20_000)
    wrapper = shared([one, two])
    assert time.process_time() - start < 30
    assert blocks(parse(one), wrapper, True) == [f"t{i}" for i in range(20_000)]
    few = shared([page(100), page(100)])
    assert len(few[1][0][1][1]) <= MOST and len(few[1][0][1][1]) > 100


def longest(x, y):
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    return best[0][0]


def test_pairs_are_a_common_subsequence():
    rng = random.Random(2)
    for size, letters in [(0, 3), (1, 2), (12, 3), (60, 9), (300, 400), (400, 3)]:
        for _ in range(10):
            x, y = ([rng.randrange(letters) for _ in range(rng.randint(size // 2, size))] for _ in range(2))
            pairs = _pairs(x, y)
            assert all(x[p] == y[q] for p, q in pairs)
            assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
            if size <= 60:
                assert len(pairs) == longest(x, y)


@pytest.mark.parametrize(("page", "said"), [
    ('<article><header class="entry-header"><h1>Title</h1></header><p>x</p></article>', ["Title", "x"]),
    ('<article><div class="header"><h1>Title</h1></div><p>x</p></article>', ["Title", "x"]),
    ('<article><p class="related-work">a</p><p class="notice-period">b</p><p class="ad-hoc">c</p></article>', ["a", "b", "c"]),
    ('<article><p>a</p><div class="ad-slot">b</div><div class="comment-list"><p>c</p></div><p>d <span class="share">e</span></p></article>', ["a", "d"]),
    ("<article><p>sum <math><mi>x</mi></math> end</p></article>", ["sum x end"]),
    ('<p><a href="foo>text</a> more', ["text more"]), ("1 < 2 and <", ["1 < 2 and <"]), ("a<!-- b", ["a"]), ("<p>a <b", ["a <b"]),
    ("<p title='>'>a</p ><script>if (a<b) '</p>'</script >b", ["a", "b"]), ("<p>a<svg><text>b</text></svg>c", ["ac"]),
])
def test_what_stays(page, said):
    assert blocks(parse(page), None, False) == said


def test_the_wrapper_decides_on_names_inside_the_article():
    """A paragraph with words of its own on every page stays whatever its name; lists of varying length and fixed words go."""
    def page(n):
        replies = "".join(f"<p>reply {n} {i}</p>" for i in range(n % 3 + 1))
        return (f'<body><article><h1>Head {n}</h1><p>Text {n}</p><p class="notice">Ruling number {n}</p><div class="comments">{replies}</div>'
                f'<p class="disclaimer">Said on all pages</p>{"<p class=promo>Now</p>" if n % 2 else ""}</article></body>')

    pages = [page(n) for n in range(8)]
    wrapper = shared(pages)
    for n, text in enumerate(pages):
        assert blocks(parse(text), wrapper, True) == [f"Head {n}", f"Text {n}", f"Ruling number {n}"]
        assert blocks(parse(text), None, False) == [f"Head {n}", f"Text {n}"]
