"""C0-C13 on the reference's inline documents (FIXTURES.md section 1)."""

import random

from pyspark.sql import functions as F

from conftest import SF, pages_df
from newsframe.operators import dom as D
from newsframe.operators import tokens as TK

DOC = "<!-- comment --><html name='froot'><sib>sib</sib><child name='fake'>test</child>foo</html>"


def _trees(spark, html):
    return D.page_trees(pages_df(spark, [html]), keep_html=True)


def _all(spark, html):
    return D.node_rows(_trees(spark, html), path=True)


def _root_text(trees):
    return D.node_rows(trees, lambda n: n["parent"] < 0, text=True).first().node_text


def test_parse_page_shapes():
    t = D.parse_page(DOC)
    assert t.tag == ["html", "sib", "child"]
    assert t.parent == [-1, 0, 0] and t.end == [2, 1, 2]
    assert t.runs == ["sib", "test", "foo"] and (t.lo, t.hi) == ([0, 0, 1], [3, 1, 2])
    assert t.has_text == [False, True, True] and t.has_tail == [False, False, True]
    assert t.attrs[0] == [("name", "froot")]


def test_paths_and_texts(spark):
    rows = _all(spark, DOC).orderBy("node_id").collect()
    assert [r.xpath for r in rows] == ["/html", "/html/sib", "/html/child"]
    assert [r.text for r in rows] == ["", "sib", "test"] and [r.tail for r in rows] == ["", "", "foo"]


def test_implied_end_tags_and_void(spark):
    rows = _all(spark, "<div><p><b>one<br><p>two</p><ul><li>a<li>b</ul></div>").orderBy("node_id").collect()
    tags, xp = [r.tag for r in rows], [r.xpath for r in rows]
    assert tags == ["div", "p", "b", "br", "p", "ul", "li", "li"]
    assert xp[4] == "/div/p[2]" and xp[3] == "/div/p[1]/b/br"
    assert xp[7] == "/div/ul/li[2]"


def test_node_text_root(spark):
    t = _trees(spark, DOC)
    assert _root_text(t) == "sib test foo"


def test_intervals_nested_and_paths_unique(spark):
    n = D.node_rows(D.page_trees(spark.read.parquet(f"{SF}/pages.parquet")), path=True)
    p = n.alias("c").join(n.alias("p"), (F.col("c.page_id") == F.col("p.page_id"))
                          & (F.col("c.parent_id") == F.col("p.node_id")))
    bad = p.filter((F.col("c.node_id") <= F.col("p.node_id")) | (F.col("c.end_id") > F.col("p.end_id")))
    assert bad.count() == 0
    assert n.groupBy("page_id", "xpath").count().filter("count > 1").count() == 0


def test_deep_pages_stay_linear(spark):
    import time
    began = time.time()
    t = D.parse_page("<div>" * 100_000 + "x")
    assert t.depth[-1] == 99_999 and t.runs == ["x"] and t.lo[0] == 0 and t.hi[0] == 1
    nodes, runs = D._tree_arrays([t])
    assert nodes.nbytes + runs.nbytes < 20_000_000 and time.time() - began < 60
    t = D.parse_page("<table><tr><td>" * 20_000 + "<p>a<p>b" * 5)
    assert t.tag.count("p") == 10 and len(set(t.parent[-10:])) == 1


def test_find_by_tag(spark):
    hit = D.find_by_tag(_trees(spark, DOC), "child", "name", "fake").collect()
    assert [(h.xpath, h.text) for h in hit] == [("/html/child", "test")]
    assert D.find_by_tag(_trees(spark, "<root>" + DOC + "</root>"), "root").count() == 0


def test_find_below_start_nodes(spark):
    html = "<div id='a'><p class='x'>1</p><div id='b'><p class='xy'>2</p><div id='c'></div></div></div><p class='x'>3</p>"
    t = _trees(spark, "<body>" + html + "</body>")

    def starts(n):
        return n["tag"] == "div"
    got = sorted((r.start_id, r.node_id, r.xpath) for r in D.find_by_tag(t, "p", "class", "X", start=starts).collect())
    assert got == [(1, 2, "/body/div/p"), (1, 4, "/body/div/div/p"), (3, 4, "/body/div/div/p")]
    # a start node is excluded only when a tag is given
    assert sorted((r.start_id, r.node_id) for r in D.find_by_tag(t, "div", start=starts).collect()) == [(1, 3), (1, 5), (3, 5)]
    assert sorted((r.start_id, r.node_id) for r in D.find_by_tag(t, attr="id", value="[bc]", start=starts).collect()) == [(1, 3), (1, 5), (3, 3), (3, 5), (5, 5)]


def test_parent_path_and_parent(spark):
    row = spark.range(1).select(D.parent_path(F.lit("fake_xpath/@1")).alias("p")).first()
    assert row.p == "fake_xpath"
    par = D.node_parent(_trees(spark, DOC), lambda n: n["tag"] == "child").first()
    assert par.parent_tag == "html" and par.parent_xpath == "/html"


def test_children_runs_prev_sibling(spark):
    t = _trees(spark, DOC)
    kids = D.node_children(t).filter("parent_id = 0").orderBy("sib_pos").collect()
    assert [(k.tag, k.text, k.tail) for k in kids] == [("sib", "sib", ""), ("child", "test", "foo")]
    runs = D.text_runs(t).filter("parent_id = 0").orderBy("run_pos").collect()
    assert [(r.kind, r.run_text) for r in runs] == [("sib", "sib"), ("child", "test"), ("text", "foo")]
    single = D.text_runs(_trees(spark, "<child name='fake'>test</child>")).collect()
    assert [(r.kind, r.run_text) for r in single] == [("text", "test")]
    prev = D.prev_sibling(t).filter("tag = 'child'").first()
    assert prev.prev_tag == "sib"


def test_comments_and_node_html(spark):
    assert [r.comment for r in TK.comments(pages_df(spark, [DOC])).collect()] == ["comment"]
    t = _trees(spark, DOC)
    html = D.node_html(t, lambda n: n["tag"] == "html").first().node_html
    assert html == "<html name='froot'><sib>sib</sib><child name='fake'>test</child>foo</html>"
    child = D.node_html(t, lambda n: n["tag"] == "child").first().node_html
    assert child == "<child name='fake'>test</child>"


def test_drop_subtree_keeps_tail(spark):
    kept = D.drop_subtree(_trees(spark, DOC), lambda n: n["tag"] == "child")
    rows = D.node_rows(kept, path=True)
    assert rows.filter("tag = 'child'").count() == 0
    assert rows.filter("tag = 'sib'").first().tail == "foo"
    assert _root_text(kept) == "sib foo"


def _dropped(spark, html, *tags):
    out = D.drop_tag(_trees(spark, html), lambda n: n["tag"].isin(*tags))
    return out, {r.tag: r for r in D.node_rows(out, path=True).collect()}


def test_drop_tag_reparents(spark):
    _, rows = _dropped(spark, "<div><span><b>x</b>y</span><i>z</i></div>", "span")
    assert rows["b"].parent_id == 0 and "span" not in rows
    assert (rows["b"].text, rows["b"].tail, rows["b"].sib_pos) == ("x", "y", 1)
    assert rows["i"].sib_pos == 2 and rows["i"].xpath == "/div/i"


def test_drop_tag_moves_text_and_tail(spark):
    # text joins the parent's text when nothing precedes it
    _, rows = _dropped(spark, "<p>a<b>bold</b>c</p>", "b")
    assert {t: r.text for t, r in rows.items()} == {"p": "aboldc"}
    # text joins the previous sibling's tail; tail goes after the last child
    _, rows = _dropped(spark, "<p><i>x</i>m<b>y<u>z</u>w</b>t</p>", "b")
    assert rows["i"].tail == "my" and rows["u"].tail == "wt" and rows["u"].parent_id == 0
    assert [rows["i"].sib_pos, rows["u"].sib_pos] == [1, 2]
    # nested removals; the subtree text is unchanged
    out, rows = _dropped(spark, "<div>s<span>a<em>b</em>c</span>d<i>e</i></div>", "span", "em")
    assert rows["div"].text == "sabcd" and rows["i"].sib_pos == 1
    assert _root_text(out) == "sabcd e"


def test_clean_doc_removes_junk(spark):
    t = _trees(spark, "<body><nav><a>x</a></nav><div class='ad'>buy</div><p>keep</p><script>s</script></body>")
    assert sorted(r.tag for r in D.node_rows(D.clean_doc(t)).collect()) == ["body", "p"]
    # the parser's mark says the same
    assert sorted(r.tag for r in D.node_rows(t, lambda n: ~n["junk"]).collect()) == ["body", "p"]


# -- edits against a plain element tree, on random pages ----------------------

def _element_tree(tree):
    kids = {i: [] for i in [-1, *tree.id]}
    for i, p in zip(tree.id, tree.parent, strict=True):
        kids[p].append(i)

    def build(i):
        text = tree.runs[tree.lo[i]] if tree.has_text[i] else ""
        tail = tree.runs[tree.hi[i]] if tree.has_tail[i] else ""
        return [i, tree.tag[i], text, tail, [build(k) for k in kids[i]]]
    return [build(i) for i in kids[-1]]


def _plain(nodes, tails):
    """(id, parent, text, tail) in document order."""
    out = []

    def walk(n, up):
        out.append((n[0], up, n[2], n[3]))
        for k in n[4]:
            walk(k, n[0])
    for n in nodes:
        walk(n, -1)
    return out


def _remove(node, gone):
    kids = []
    for k in node[4]:
        if k[1] in gone:
            if k[3] and kids:
                kids[-1][3] = f"{kids[-1][3]} {k[3]}" if kids[-1][3] else k[3]
            elif k[3]:
                node[2] = f"{node[2]} {k[3]}" if node[2] else k[3]
        else:
            _remove(k, gone)
            kids.append(k)
    node[4] = kids


def _unwrap(node, gone):
    for k in node[4]:
        _unwrap(k, gone)
    kids = []

    def add(text):
        if kids:
            kids[-1][3] += text
        else:
            node[2] += text
    for k in node[4]:
        if k[1] in gone:
            add(k[2])
            kids.extend(k[4])
            add(k[3])
        else:
            kids.append(k)
    node[4] = kids


def _random_html(rng, depth=0):
    out = []
    for _ in range(rng.randint(0, 4 if depth < 5 else 0)):
        tag = rng.choice(["div", "span", "b", "i", "em", "nav", "br", "q"])
        text = rng.choice(["", "", "t%d" % rng.randint(0, 99)])
        out.append(f"<{tag}>" if tag == "br" else f"<{tag} k='a&amp;\"{rng.randint(0, 9)}'>{rng.choice(['', 'x < %d &amp; ' % rng.randint(0, 99)])}{_random_html(rng, depth + 1)}</{tag}>")
        out.append(text)
    return "".join(out)


def test_edits_and_serialisation_on_random_pages(spark):
    rng = random.Random(4)
    docs = [f"<body>{_random_html(rng)}</body>" for _ in range(60)] + [None, ""]
    trees = D.page_trees(pages_df(spark, docs))
    inline = ["b", "i", "em", "span", "br"]
    removed = D.drop_subtree(trees, lambda n: n["tag"].isin("nav", "q"))
    both = D.drop_tag(removed, lambda n: n["tag"].isin(*inline))
    plain = {}
    for i, d in enumerate(docs):
        for name, gone, how in (("removed", {"nav", "q"}, _remove), ("both", set(inline), _unwrap)):
            roots = _element_tree(D.parse_page(d)) if name == "removed" else roots
            for r in roots:
                how(r, gone)
            plain[name, i] = _plain(roots, True)
    for name, df in (("removed", removed), ("both", both)):
        got = {}
        for r in D.node_rows(df).orderBy("page_id", "node_id").collect():
            got.setdefault(r.page_id, []).append((r.node_id, r.parent_id, r.text, r.tail))
        assert {i: got.get(i, []) for i in range(len(docs))} == {i: plain[name, i] for i in range(len(docs))}, name
    # Written and parsed again, an edited tree is the same up to its numbers
    html = D.serialised(both, lambda n: n["parent"] < 0).collect()
    assert len(html) == 60
    for r in html:
        again = D.parse_page(r.node_html)
        number = {node: k for k, (node, *_) in enumerate(plain["both", r.page_id])}
        assert _plain(_element_tree(again), True) == [(number[a], number.get(b, -1), c, d) for a, b, c, d in plain["both", r.page_id]]
    tags = {r.page_id: r.t for r in both.select("page_id", F.transform("nodes", lambda n: n["attrs"]).alias("t")).collect()}
    for r in html:
        assert [dict(a) for a in D.parse_page(r.node_html).attrs] == tags[r.page_id]


def test_edits_of_a_long_page_are_linear(spark):
    import time
    html = "<body>" + "<div><nav><a>x</a></nav>t</div><b>y</b>" * 12_500 + "</body>"
    trees = _trees(spark, html)
    began = time.time()
    out = D.clean_doc(trees, unwrap_inline=True).select(F.size("nodes").alias("n"), F.size("runs").alias("r")).first()
    assert out.n == 12_501 and time.time() - began < 60


def test_partitioning_does_not_change_results(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    a = D.node_rows(D.page_trees(df.coalesce(1)), path=True).select("page_id", "node_id", "xpath", "text")
    b = D.node_rows(D.page_trees(df.repartition(7)), path=True).select("page_id", "node_id", "xpath", "text")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batches_end_after_many_nodes():
    import pyarrow as pa
    html = "<html><body>" + "<p>x</p>" * 2500 + "</body></html>"
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([html, "<a>y</a>", None])], ["page_id", "html"])
    out = list(D._parse_batches([batch], most_nodes=1000))
    assert [b.num_rows for b in out] == [1, 2]
    assert [len(v) for b in out for v in b.column(1)] == [2502, 1, 0]
    assert [i for b in out for i in b.column(0).to_pylist()] == [1, 2, 3]


def test_edits_take_a_batch_apart_in_slices():
    import pyarrow as pa
    docs = ["<body>" + "<p>x<b>y</b></p>" * 1000 + "</body>", "<a>y</a>", None, "<i>z</i>"] * 3
    trees = [D.parse_page(d) for d in docs]
    gone = pa.array([[i for i, tag in enumerate(t.tag) if tag == "b"] for t in trees], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(12)), *D._tree_arrays(trees), gone], ["page_id", "nodes", "runs", "_gone"]).slice(1)
    whole, parts = (list(D._edit(D._without_tags, most_nodes=n)([batch])) for n in (1 << 30, 1000))
    assert [b.num_rows for b in whole] == [11] and [b.num_rows for b in parts] == [4, 4, 3]
    assert pa.Table.from_batches(whole).to_pylist() == pa.Table.from_batches(parts).to_pylist()
    default = list(D._edit(D._without_tags)([pa.RecordBatch.from_arrays([c.take(pa.array(list(range(11)) * 20)) for c in batch.columns], names=batch.schema.names)]))
    assert len(default) > 10 and sum(b.num_rows for b in default) == 220


def test_clean_doc_unwrap_inline(spark):
    t = _trees(spark, "<body><nav>x</nav><p>a <b>bold</b> c<br>d</p></body>")
    rows = {r.tag: r for r in D.node_rows(D.clean_doc(t, unwrap_inline=True)).collect()}
    assert sorted(rows) == ["body", "p"]
    assert rows["p"].text == "a bold cd"
