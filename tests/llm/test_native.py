"""Chat formatting, URL filters and fingerprints."""

import hashlib
from itertools import zip_longest

import pytest
from pyspark.sql import functions as F

from clickmill.llm import op1_chat_format as chat
from clickmill.llm import op2_url_filter as urls
from clickmill.llm import op6_fingerprint as prints

HARD = ["", None, "\\", "\\n", "<|", "<\\|", "<|im_end|>", "a<|im_start|>user\nb", "<", "|>", "\\\\|<|\\", "line\nline", "Ünï ☃"]


def test_every_text_comes_back(spark):
    rows = [(i, t, role, text) for i, text in enumerate(HARD) for t, role in ((0, "user"), (1, "assistant"))]
    rows += [(90 + i, 0, role, "x") for i, role in enumerate(HARD)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(turns).withColumn("turns", chat.read_back(F.col("formatted")))
    got = {r.conv_id: r for r in out.collect()}
    for i, text in enumerate(HARD):
        assert [tuple(t) for t in got[i].turns] == [("user", text or ""), ("assistant", text or "")]
        assert got[90 + i].turns[0].role == (text or "")
        assert "".join(s.text for s in got[i].segments) == got[i].formatted
        assert [s.loss for s in got[i].segments] == [False, False, False, False, True, False]


def test_order_is_judged_by_the_machine(spark):
    talks = {1: "su", 2: "sua", 3: "uaua", 4: "au", 5: "uua", 6: "ss", 7: "ux", 8: "uas"}
    names = {"s": "system", "u": "user", "a": "assistant", "x": "critic"}
    rows = [(i, t, names[c], "t") for i, talk in talks.items() for t, c in enumerate(talk)]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.conv_id: (r.valid, r.failed_at) for r in out.collect()} == {
        1: (True, None), 2: (True, None), 3: (True, None), 4: (False, 0), 5: (False, 1), 6: (False, 1), 7: (False, 1), 8: (False, 2)}


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, valid int, segments int"
    assert chat.format_chats(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, 1, "assistant", "b", 1, 1), (None, None, "user", "a", 1, 1), (5, 0, "user", "x" * 400_000, 1, 1),
            (6, 0, "user", "same", 1, 1), (6, 0, "user", "same", 1, 1)]
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, schema)).collect()}
    assert [s.text for s in got[None].segments][1::3] == ["a", "b"] and len(got[5].formatted) > 400_000
    assert len(got[6].segments) == 6 and not got[6].valid


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[cut:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:stop]


def rule_of(host, path):
    fits = [(h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


def test_rules_and_trees(spark):
    good = [f"https://{w}.example.com/en/{i}" for i, w in enumerate(["blog.alba", "www.notes", "m.garden", "city"] * 30)]
    bad = [f"http://{w}.example.com/en/{i}" for i, w in enumerate(["www.cheap-pills", "m.casino-win", "spam-farm"] * 20)]
    odd = [None, "", "no scheme", "ftp://A.NET", "http://a.net/", "http://net/x", "http://xnet/", "https://EN.example.NET/en/1",
           "https://example.net/de", "x://a.example.com/de/?q", "x://b.org/fr/#f", "x://org/fr", "a://b://c.net/", "http://?x=/", "u://h" + "/a" * 50_000]
    pages = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(good + bad + odd + odd)],
                                  "page_id long, url string, host int, label int")
    got = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    assert len(got) == len(good + bad + odd + odd)
    for i, u in enumerate(good + bad + odd + odd):
        host, path = host_path(u)
        rule, verdict = rule_of(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (verdict or got[i].verdict)
    assert sum(got[i].verdict == "block" for i in range(len(good))) == 0
    assert all(got[len(good) + i].verdict == "block" for i in range(len(bad)))


def test_suffixes_are_counted_on_all_pages(spark, monkeypatch):
    """The trees see few rows, but the other pages of each host count."""
    fit_on = urls.labelled
    monkeypatch.setattr(urls, "labelled", lambda featured, rows: fit_on(featured, rows, 100))
    hosts = [(f"{'win' if k * 7 % 11 % 2 else 'niw'}-{k}.t{k % 7}.test", k * 7 % 11 % 2) for k in range(100, 300)]
    rows = [(10 * k + i, f"http://{host}/{10 + i}", bad) for k, (host, bad) in enumerate(hosts) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, bad int")
    got = urls.judge_urls(pages).join(pages.drop("url"), "page_id").collect()
    assert len(got) == len(rows) and sum((r.verdict == "block") != r.bad for r in got) <= len(rows) // 50


def test_no_pages(spark):
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


@pytest.mark.parametrize("bucket", [4096, 1])
@pytest.mark.parametrize("which", ["edge_docs", "small_docs"])
def test_fingerprints(request, which, bucket, monkeypatch):
    monkeypatch.setattr(prints, "BUCKET_ROWS", bucket)
    docs = request.getfixturevalue(which)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: r[1], reverse=True)
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = sorted((tuple(r) for r in prints.judged(docs).collect()), key=repr)
    want, node, edits = [], {}, {}
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        want.append((i, len(text), digest))
        edits[i, len(text), digest] = text, edited, after
        node.setdefault(text, set())
    assert [g[:3] for g in got] == sorted(want, key=repr)
    by_text = {}
    for r in prints.fingerprints(docs.withColumn("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))))).collect():
        by_text.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values()) and len({min(v) for v in by_text.values()}) == len(node)
    assert all(0 <= x <= 1 for g in got for x in g[5:7])
    seen = {}
    for g in got:
        text, edited, after = edits[g[:3]]
        for one, printed in ((text, g[3]), (edited, g[4])):
            assert [h for h in print_of(printed)[1]] == [short_nodes(s) for s in sections_of(one)]
            assert printed.startswith(root_of(one) + ";")
            seen[one] = printed
        first = next((k for k, (a, b) in enumerate(zip_longest(text.split("\n"), edited.split("\n"))) if a != b), None)
        assert g[7] == first
    for g in got:
        text, edited, after = edits[g[:3]]
        assert g[5] == pytest.approx(like(seen[text], seen[edited]), abs=1e-12)
        assert g[6] == pytest.approx(like(seen[text], seen[after]), abs=1e-12)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sections_of(text):
    """Full leaf hashes by section."""
    out = [[]]
    for leaf in map(sha, text.split("\n")):
        out[-1].append(leaf)
        if leaf[0] < "4":
            out.append([])
    return [s for s in out if s]


def root_of(text):
    return sha(",".join(sha(",".join(s)) for s in sections_of(text)))


def short_nodes(section):
    return sha(",".join(section))[:16], tuple(h[:16] for h in section)


def print_of(printed):
    """Root, nodes and leaves by section, and the sections as sets of leaves with their pieces."""
    root, *sections = printed.split(";")
    parts = [s.split(",") for s in sections]
    leaves = [(p[0], tuple((leaf[:16], tuple(x for x in leaf[16:].split(".") if x)) for leaf in p[1:])) for p in parts]
    return root, [(node, tuple(h for h, _ in own)) for node, own in leaves], leaves


def like(a, b):
    """Likeness of two fingerprints, level by level."""
    (root_a, _, one), (root_b, _, two) = print_of(a), print_of(b)
    if root_a == root_b:
        return 1.0
    weight = sum(len(pieces) for _, own in set(one) & set(two) for _, pieces in own)
    alone = [{leaf for _, own in set(x) - set(y) for leaf in own} for x, y in ((one, two), (two, one))]
    weight += sum(len(pieces) for _, pieces in alone[0] & alone[1])
    left, right = ({p for _, pieces in x - y for p in pieces} for x, y in (alone, alone[::-1]))
    both = 2 * weight + len(left) + len(right)
    return 2 * (weight + len(left & right)) / both if both else 0.0


def test_edits_are_located(spark):
    text = "\n".join(f"paragraph number {i} says that {i * i} is a square, and so on" for i in range(40))
    changed = text.replace("number 17 says", "number 17 claims")
    row = spark.createDataFrame([(text, changed)], "a string, b string").select(
        prints.first_edit(prints.tree(F.col("a")), prints.tree(F.col("b"))).alias("first"),
        prints.differing(prints.tree(F.col("a")), prints.tree(F.col("b"))).alias("where"),
        prints.likeness(prints.tree(F.col("a")), prints.tree(F.col("b"))).alias("like"),
        prints.likeness(prints.tree(F.col("a")), prints.tree(F.col("a"))).alias("same")).first()
    assert row["where"] == [17] and row["first"] == 17 and 0.9 < row["like"] < 1 and row["same"] == 1


def test_long_edited_documents_are_located(spark):
    """Likeness and place of an edit do not compare all paragraphs with all others."""
    lines = [f"line {i} of a text that has very many of them" for i in range(60_000)]
    changed = [line + "!" if i >= 30_000 else line for i, line in enumerate(lines)]
    row = spark.createDataFrame([("\n".join(lines), "\n".join(changed))], "a string, b string").select(
        prints.tree(F.col("a")).alias("a"), prints.tree(F.col("b")).alias("b")).select(
        prints.likeness(F.col("a"), F.col("b")).alias("like"), prints.first_edit(F.col("a"), F.col("b")).alias("first")).first()
    assert row["first"] == 30_000 and 0.5 < row["like"] < 1


def test_order_of_many_buckets(spark, monkeypatch):
    """Each document meets its next one where buckets are few to a group and some are empty."""
    monkeypatch.setattr(prints, "BUCKET_ROWS", 2)
    monkeypatch.setattr(prints, "GROUP_BUCKETS", 3)
    ids = [i * i * 7 for i in range(150)]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.following for r in prints.with_next(docs).collect()}
    assert got == {i: f"text {ids[k - 1]}" for k, i in enumerate(ids)}


def test_no_documents(no_docs):
    assert prints.judged(no_docs).collect() == []
