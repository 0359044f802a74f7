"""F16-F19 scoring on constructed documents."""

from conftest import pages_df
from newsframe.operators import body as B
from newsframe.operators import dom as D

SW = ["the", "and", "of"]


def _run(spark, html):
    t = D.page_trees(pages_df(spark, [html]))
    return t, B.text_blocks(t, words=SW), B.block_scores(t, words=SW)


def test_boost_and_parent_scores(spark):
    html = "<html><body><div><p>the and of</p><p>the and of</p></div></body></html>"
    n, blocks, scores = _run(spark, html)
    s = scores.orderBy("i").collect()
    assert [(r.boostable, r.upscore) for r in s] == [(False, 3), (True, 53)]
    top = B.best_node(n, words=SW).first()
    assert top.text_path == "/html/body/div//text()" and top.top_score == 56.0


def test_tail_penalty_small_and_large(spark):
    ps = "".join("<p>the and of x</p>" for _ in range(16))
    _, _, scores = _run(spark, f"<html><body><div>{ps}</div></body></html>")
    tail = {r.i: r.boost for r in scores.collect() if r.i >= 12}
    assert tail == {12: -0.0, 13: -1.0, 14: -4.0, 15: -9.0}
    ps = "".join("<p>the and of x</p>" for _ in range(32))
    _, _, scores = _run(spark, f"<html><body><div>{ps}</div></body></html>")
    assert {r.i: r.boost for r in scores.collect()}[31] == 5.0


def test_no_blocks_no_body(spark):
    n, blocks, scores = _run(spark, "<html><body><p>x</p></body></html>")
    assert blocks.count() == 0 and B.best_node(n, words=SW).count() == 0


def test_link_density_filters_nav_like_blocks(spark):
    html = "<html><body><div><p><a href='/1'>the and of x</a> y</p><p>the and of</p></div></body></html>"
    _, blocks, _ = _run(spark, html)
    assert [r.stopwords for r in blocks.collect()] == [3]


def test_body_text_runs(spark):
    html = "<html><body><article><p>the and of <b>bold</b> tail</p><p>the and of</p></article>end</body></html>"
    n, _, scores = _run(spark, html)
    text = B.body_text(n, words=SW).first().text
    assert text == "the and of \nbold\n tail\nthe and of\n"


def _plain_scores(blocks, n):
    """(i, boostable, upscore) of kept blocks (sibling before is kept, stop words)."""
    out, k = [], 0
    for i, (follows, stop) in enumerate(blocks):
        k += follows
        boost = 50 / k if follows else 0.0
        if n > 15 and n - i <= n * 0.25:
            b = n * 0.25 - (n - i)
            boost = 5.0 if b * b > 40 else -b * b
        out.append((i, follows, int(stop + boost)))
    return out


def test_scores_and_best_node_against_a_plain_fold(spark):
    import random
    rng = random.Random(8)
    docs, plans = [], []
    for _ in range(40):
        groups = [[rng.randint(0, 6) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 6))]
        docs.append("<html><body>" + "".join(f"<section><div>{''.join('<p>' + 'the ' * w + '</p>' for w in g)}</div></section>" for g in groups) + "</body></html>")
        plans.append(groups)
    t = D.page_trees(pages_df(spark, docs))
    got = {}
    for r in B.block_scores(t, words=SW).orderBy("page_id", "i").collect():
        got.setdefault(r.page_id, []).append((r.i, r.boostable, r.upscore))
    best = {r.page_id: (r.top_score, r.text_path) for r in B.best_node(t, words=SW).collect()}
    for d, groups in enumerate(plans):
        kept = [(g, j, w) for g, ws in enumerate(groups) for j, w in enumerate(ws) if w > 2]
        scores = _plain_scores([(j > 0 and groups[g][j - 1] > 2, w) for g, j, w in kept], len(kept))
        assert got.get(d, []) == scores
        total = {}
        for (g, _, _), (i, _, up) in zip(kept, scores, strict=True):
            for node, add in ((f"section{g}/div", up), (f"section{g}", up / 2)):
                total[node] = total.get(node, 0.0) + add
        if not kept:
            assert d not in best
            continue
        top = max(total, key=lambda k: (total[k] > 0, total[k] if total[k] > 0 else 0.0))
        if total[top] <= 0:
            top = next(iter(total))
        g = int(top.removeprefix("section").split("/")[0])
        step = f"section[{g + 1}]" if len(groups) > 1 else "section"
        assert best[d] == (total[top], f"/html/body/{step}{'/div' if top.endswith('div') else ''}//text()")
