"""The Jaccard join against all pairs, with regions split as far as they go."""

import re

import pytest

from clickmill.llm import op10_jaccard_join as m
from clickmill.llm.components import components


def brute(rows, width=4, percent=85):
    low = min((i for i, _ in rows if i is not None), default=1) - 1
    sets = []
    for i, text in rows:
        w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
        sets.append(({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    ids = [low if i is None else i for i, _ in rows]
    least = {}
    for k in range(len(rows)):
        least[root(k)] = min(least.get(root(k), ids[k]), ids[k])
    return sorted(((rows[k][0], len(sets[k]), least[root(k)]) for k in range(len(rows))), key=repr)


@pytest.mark.parametrize("leaf", [8, 1])
@pytest.mark.parametrize("which", ["edge_docs", "small_docs"])
def test_components(request, which, leaf, monkeypatch):
    monkeypatch.setattr(m, "LEAF", leaf)
    monkeypatch.setattr(m, "ROUNDS", 1)
    monkeypatch.setattr(m, "BLOCK", 2)
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in m.jaccard_components(docs).collect()]
    assert sorted(got, key=repr) == brute(rows)


@pytest.mark.parametrize("leaf", [8, 1])
def test_all_links(edge_docs, spark, leaf, monkeypatch):
    """Every pair of different sets, also of one component, and the number of rows each row is linked with."""
    monkeypatch.setattr(m, "LEAF", leaf)
    monkeypatch.setattr(m, "BLOCK", 2)
    base = [f"v{i}" for i in range(120)]
    near = [(100 + k, " ".join([*base[:6 * k], f"own{k}", *base[6 * k + 1:]])) for k in range(20)]
    added = spark.createDataFrame([*near, (150, near[3][1]), (90, near[3][1])], "doc_id long, text string")
    docs = edge_docs.select("doc_id", "text").union(added)
    sets = []
    for r in docs.collect():
        w = (re.sub("[A-Z]", lambda c: c[0].lower(), r.text or "")).split()
        sets.append((r.doc_id, frozenset(tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()))

    def linked(a, b):
        return bool(a & b) and 100 * len(a & b) >= 85 * len(a | b)

    links, rows = m.jaccard_links(docs)
    want = sorted(((i, len(one), sum(linked(one, other) for _, other in sets) - bool(one)) for i, one in sets), key=repr)
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in rows.collect()), key=repr) == want
    different = sorted({one for _, one in sets}, key=sorted)
    pairs = sorted((len(a & b), len(a | b)) for i, a in enumerate(different) for b in different[:i] if linked(a, b))
    got = links.collect()
    assert sorted((r.shared, r.joint) for r in got) == pairs and all(r.u < r.v for r in got) and len(pairs) > 100
    assert {r.u for r in got} | {r.v for r in got} <= {r.class_id for r in rows.collect()}


def test_copies_in_falling_order_of_their_ids(spark):
    """Classes whose smallest id stands behind copies in one record batch still meet near copies."""
    rows = []
    for k in range(3):
        words = [f"w{k}x{i}" for i in range(60)]
        copy, near = " ".join(words), " ".join([*words[:-1], "changed"])
        rows += [(900 - k, copy), (500 - k, near), (300 - k, copy), (30 - k, copy)]
    rows.sort(reverse=True)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in m.jaccard_components(docs).collect()]
    assert sorted(got, key=repr) == brute(rows) and {g[2] for g in got} == {30, 29, 28}


def test_no_documents(no_docs):
    assert m.jaccard_components(no_docs).collect() == []
    assert [df.collect() for df in m.jaccard_links(no_docs)] == [[], []]


def test_one_of_each_group_stays(edge_docs):
    out = m.one_of_each(edge_docs)
    ids = sorted((r.doc_id for r in out.collect()), key=repr)
    assert out.columns == edge_docs.columns
    assert 1 in ids and 2 not in ids and 3 not in ids and ids.count(20) == 1 and ids.count(21) == 2 and ids.count(None) == 2
    assert {4, 5, 6, 7, 9} <= set(ids) and 8 not in ids and 10 not in ids


def test_long_chain_is_one_component(spark):
    edges = spark.range(200).selectExpr("id + 1 AS u", "id AS v").union(spark.createDataFrame([(500, 501)], "u long, v long"))
    found = {r.doc: r.component for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
