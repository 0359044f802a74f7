"""Page trees.

``page_trees`` (C0) is the only place where Python reads HTML: an Arrow-batched
``mapInArrow`` task runs the standard-library tokenizer over the pages of its partition
and returns every page row with two columns in place of ``html``:

    nodes array<struct>   the elements in document order (``NODE``)
    runs array<string>    the page's text runs in document order

A node's ``id`` is its pre-order number and ``end`` the number of its last descendant, so the
subtree of ``a`` is ``id BETWEEN a.id AND a.end``. Nothing is stored twice: a node has its parent's
number and its own step, no path and no ancestor list, and its place in the runs, no subtree
text. ``lo`` and ``hi`` delimit the runs of its subtree; its own leading text is run ``lo`` where
``has_text``, and the text behind its end tag is run ``hi`` where ``has_tail``. Paths (``path_of``) and texts
(``inner_text``) are built for result nodes only. Memory and time grow with the length of a page, not
with its depth.

Everything about a page is in its row, so the operators are projections of that row and need
no shuffle; columns of the input pages (such as ``url``) are carried along.
``node_rows`` gives one row per element where rows are wanted. Tree edits (C11-C13) map trees to trees.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsframe.functions.text import inner_trim
from newsframe.session import estimated_bytes

#: Fields of a node and their Arrow types.
NODE = [
    ("id", pa.int32()), ("parent", pa.int32()), ("end", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()),
    ("sib_pos", pa.int32()),  # place among all siblings, from 1
    ("tag_pos", pa.int32()),  # place among siblings with the same tag, from 1
    ("single", pa.bool_()),  # no sibling has the same tag
    ("prev", pa.int32()),  # the sibling before, or -1
    ("attrs", pa.map_(pa.string(), pa.string())),
    ("has_text", pa.bool_()), ("has_tail", pa.bool_()), ("lo", pa.int32()), ("hi", pa.int32()),
    ("src_start", pa.int32()), ("src_end", pa.int32()),  # the element's markup in the page
    ("marks", pa.int32()),  # AUTHOR_MARK, KEYED_MARK
    ("junk", pa.bool_()),  # inside a subtree that C13 removes
    ("words", pa.int32()),  # white-space separated words of the subtree
    ("link_words", pa.int64()),  # the same, summed over the ``a`` elements of the subtree
]
_NODE_ARROW = pa.struct(NODE)
_SPARK_TYPES = {"int32": T.IntegerType(), "int64": T.LongType(), "string": T.StringType(), "bool": T.BooleanType()}
NODE_SCHEMA = T.StructType([T.StructField(n, T.MapType(T.StringType(), T.StringType()) if n == "attrs" else _SPARK_TYPES[str(t)]) for n, t in NODE])
TREE_FIELDS = [T.StructField("nodes", T.ArrayType(NODE_SCHEMA)), T.StructField("runs", T.ArrayType(T.StringType()))]

# Attributes that name an element; an author probe (F4) looks for one of these words in them.
TEXT_ATTRS = ("name", "rel", "itemprop", "class", "id")
TEXT_ATTR_RE = re.compile(r"author|byline|dc.creator", re.IGNORECASE)
AUTHOR_MARK = 1
# Attributes that key metadata.
KEY_ATTRS = ("property", "name", "itemprop")
KEYED_MARK = 2

# HTML void elements (never have content or an end tag).
VOID_TAGS = frozenset(
    "area base basefont br col command embed frame hr img input isindex keygen "
    "link meta param source track wbr".split())

# Start tags that implicitly close an open <p>.
P_CLOSERS = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "li main menu nav ol p pre section table ul".split())

# Elements that bound the search for an implicitly closed tag.
SCOPE_TAGS = frozenset(
    "applet button caption html marquee object table td th template".split())

# Start tag -> open tags it implicitly closes, and the tags that
# stop the search.
SELF_CLOSERS = {
    "li": ({"li"}, {"ul", "ol", "menu", "table", "td", "th", "html", "body"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "html", "body"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "html", "body"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot", "html"}),
    "td": ({"td", "th"}, {"tr", "table", "html"}),
    "th": ({"td", "th"}, {"tr", "table", "html"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table", "html"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table", "html"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table", "html"}),
    "option": ({"option"}, {"select", "datalist", "html"}),
}

# The cleaner's choices (ours; the reference inherits one).
CLEAN_DROP_TAGS = ["script", "style", "nav", "footer", "aside", "form", "noscript"]
CLEAN_AD_PATTERN = r"(?i)(^|[\s_-])(ad|ads|advert|advertisement|banner|sponsor)([\s_-]|$)"
CLEAN_UNWRAP_TAGS = ["b", "i", "em", "strong", "span", "br"]
_AD_RE = re.compile(CLEAN_AD_PATTERN, re.ASCII)

# The parser runs in executor Python workers, which need not have this
# package installed: ship this module's code with the task (by value).
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: rely on the package being installed
    pass

_SEP = "\x00"  # marks where a comment split a text run
_SEP_RUN = re.compile(_SEP + "+")


class _TreeBuilder(HTMLParser):
    """Builds the pre-order element table of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.end: list[int] = []
        self.attrs: list[list[tuple[str, str]]] = []
        self.text: list[list[str]] = []
        self.tail: list[list[str]] = []
        self.stack: list[int] = []
        self.last_child: dict[int, int] = {}
        self.last_root = -1
        self.src_start: list[int] = []
        self.src_end: list[int] = []
        self.open_at: dict[str, list[int]] = {}  # open tags: their places on the stack
        self._doc = ""
        self._line_starts = [0]

    def parse(self, html: str) -> None:
        self._doc = html
        starts = [0]
        find = html.find
        i = find("\n")
        while i >= 0:
            starts.append(i + 1)
            i = find("\n", i + 1)
        self._line_starts = starts
        self.feed(html)
        self.close()

    def _offset(self) -> int:
        line, col = self.getpos()
        return self._line_starts[line - 1] + col

    # -- tree building -------------------------------------------------
    def _open(self, tag: str, attrs) -> int:
        nid = len(self.tags)
        parent = self.stack[-1] if self.stack else -1
        seen: dict[str, str] = {}
        for k, v in attrs:
            if k not in seen:  # first duplicate attribute wins
                seen[k] = "" if v is None else v
        self.tags.append(tag)
        self.parent.append(parent)
        self.depth.append(len(self.stack))
        self.end.append(nid)
        self.attrs.append(list(seen.items()))
        self.text.append([])
        self.tail.append([])
        here = self._offset()
        self.src_start.append(here)
        self.src_end.append(here)
        return nid

    def _close_top(self, src_end: int | None = None) -> None:
        nid = self.stack.pop()
        self.open_at[self.tags[nid]].pop()
        self.end[nid] = len(self.tags) - 1
        self.src_end[nid] = self._offset() if src_end is None else src_end
        if self.stack:
            self.last_child[self.stack[-1]] = nid
        else:
            self.last_root = nid

    def _close_through(self, targets, stops) -> None:
        at = self._innermost(targets)
        if at >= 0 and at > self._innermost(stops):
            while len(self.stack) > at:
                self._close_top()

    def _innermost(self, tags) -> int:
        """Place on the stack of the innermost open element with one of the tags, or -1."""
        at = -1
        for t in tags:
            places = self.open_at.get(t)
            if places and places[-1] > at:
                at = places[-1]
        return at

    def handle_starttag(self, tag, attrs):
        if tag in P_CLOSERS:
            self._close_through({"p"}, SCOPE_TAGS)
        rule = SELF_CLOSERS.get(tag)
        if rule is not None:
            self._close_through(*rule)
        nid = self._open(tag, attrs)
        self.open_at.setdefault(tag, []).append(len(self.stack))
        self.stack.append(nid)
        if tag in VOID_TAGS:
            raw = self.get_starttag_text() or ""
            self._close_top(self.src_start[nid] + len(raw))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and self.stack and self.tags[self.stack[-1]] == tag:
            nid = self.stack[-1]
            self._close_top(self.src_start[nid] + len(self.get_starttag_text() or ""))

    def handle_endtag(self, tag):
        if tag in VOID_TAGS:
            return
        i = self._innermost((tag,))
        if i >= 0:
            here = self._offset()
            gt = self._doc.find(">", here)
            stop = len(self._doc) if gt < 0 else gt + 1
            while len(self.stack) > i + 1:
                self._close_top(here)  # implicitly closed inside
            self._close_top(stop)

    def _slot(self) -> list[str] | None:
        if self.stack:
            top = self.stack[-1]
            child = self.last_child.get(top)
            return self.tail[child] if child is not None else self.text[top]
        if self.last_root >= 0:
            return self.tail[self.last_root]
        return None

    def handle_data(self, data):
        slot = self._slot()
        if slot is not None:
            slot.append(data)

    def handle_comment(self, data):
        slot = self._slot()
        if slot is not None:
            slot.append(_SEP)

    # -- output ----------------------------------------------------------
    def tree(self) -> "Tree":
        while self.stack:
            self._close_top(len(self._doc))
        texts = [_join_run(t) for t in self.text]
        tails = [_join_run(t) for t in self.tail]
        return Tree(list(range(len(self.tags))), self.parent, self.end, self.depth, self.tags, self.attrs, texts, tails, self.src_start, self.src_end)


class Tree:
    """One page's elements in document order, with what follows from their nesting."""

    def __init__(self, ids, parent, end, depth, tags, attrs, texts, tails, src_start, src_end):
        self.id, self.parent, self.end, self.depth, self.tag, self.attrs = ids, parent, end, depth, tags, attrs
        self.src_start, self.src_end = src_start, src_end
        n = len(ids)
        at = {node: i for i, node in enumerate(ids)}
        up = [at.get(p, -1) for p in parent]
        self.has_text, self.has_tail = [bool(t) for t in texts], [bool(t) for t in tails]
        # text runs in document order: a node's tail follows its last descendant
        runs: list[str] = []
        lo, hi = [0] * n, [0] * n
        open_at: list[int] = []
        for i in range(n):
            while open_at and open_at[-1] != up[i]:
                j = open_at.pop()
                hi[j] = len(runs)
                if tails[j]:
                    runs.append(tails[j])
            lo[i] = len(runs)
            if texts[i]:
                runs.append(texts[i])
            open_at.append(i)
        while open_at:
            j = open_at.pop()
            hi[j] = len(runs)
            if tails[j]:
                runs.append(tails[j])
        self.runs, self.lo, self.hi = runs, lo, hi
        # siblings
        counts: dict[tuple[int, str], int] = {}
        seen: dict[int, int] = {}
        last: dict[int, int] = {}
        self.sib_pos, self.tag_pos, self.prev = [0] * n, [0] * n, [-1] * n
        for i in range(n):
            p, key = parent[i], (parent[i], tags[i])
            counts[key] = self.tag_pos[i] = counts.get(key, 0) + 1
            seen[p] = self.sib_pos[i] = seen.get(p, 0) + 1
            self.prev[i] = last.get(p, -1)
            last[p] = ids[i]
        self.single = [counts[(parent[i], tags[i])] == 1 for i in range(n)]
        # facts that consumers ask of many nodes
        total = [0]
        for run in runs:
            total.append(total[-1] + len(run.split()))
        self.words = [total[hi[i]] - total[lo[i]] for i in range(n)]
        self.link_words = [self.words[i] if tags[i] == "a" else 0 for i in range(n)]
        for i in range(n - 1, 0, -1):
            if up[i] >= 0:
                self.link_words[up[i]] += self.link_words[i]
        self.marks, self.junk = [0] * n, [False] * n
        for i in range(n):
            for k, v in attrs[i]:
                if k in KEY_ATTRS:
                    self.marks[i] |= KEYED_MARK
                if k in TEXT_ATTRS and v and TEXT_ATTR_RE.search(v):
                    self.marks[i] |= AUTHOR_MARK
            self.junk[i] = (up[i] >= 0 and self.junk[up[i]]) or _is_junk(tags[i], attrs[i])


def _is_junk(tag: str, attrs) -> bool:
    return tag in CLEAN_DROP_TAGS or any(k in ("class", "id") and v and _AD_RE.search(v) for k, v in attrs)


def _join_run(pieces: list[str]) -> str:
    if not pieces:
        return ""
    s = "".join(pieces)
    if _SEP in s:
        s = _SEP_RUN.sub(" ", s.strip(_SEP))
    return s


def parse_page(html: str | None) -> Tree:
    """The tree of one page (used by the Arrow task)."""
    builder = _TreeBuilder()
    if html:
        builder.parse(html)
    return builder.tree()


def _tree_arrays(trees: list[Tree]) -> list[pa.Array]:
    """The ``nodes`` and ``runs`` columns of some pages."""
    def flat(name):
        return [v for t in trees for v in getattr(t, name)]

    def offsets(sizes):
        out = [0]
        for k in sizes:
            out.append(out[-1] + k)
        return pa.array(out, pa.int32())

    fields = []
    for name, kind in NODE:
        if name == "attrs":
            attrs = flat(name)
            fields.append(pa.MapArray.from_arrays(offsets(map(len, attrs)), pa.array([k for a in attrs for k, _ in a], pa.string()),
                                                  pa.array([v for a in attrs for _, v in a], pa.string())))
        else:
            fields.append(pa.array(flat(name), kind))
    nodes = pa.StructArray.from_arrays(fields, names=[name for name, _ in NODE])
    return [pa.ListArray.from_arrays(offsets(len(t.id) for t in trees), nodes),
            pa.ListArray.from_arrays(offsets(len(t.runs) for t in trees), pa.array(flat("runs"), pa.string()))]


def _parse_batches(batches, most_nodes: int = 1 << 14):
    """Arrow task: page rows in, the same rows with ``nodes`` and ``runs`` for ``html`` (the last column) out,
    in batches that end with the page that reaches ``most_nodes``."""
    for batch in batches:
        docs = batch.column(batch.num_columns - 1)
        names = batch.schema.names[:-1] + ["nodes", "runs"]
        first, trees, held = 0, [], 0
        for i in range(batch.num_rows):
            trees.append(parse_page(docs[i].as_py()))
            held += len(trees[-1].id)
            if held >= most_nodes or i + 1 == batch.num_rows:
                kept = [c.slice(first, len(trees)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(kept + _tree_arrays(trees), names=names)
                first, trees, held = i + 1, [], 0


def spread_pages(pages: DataFrame) -> DataFrame:
    """Give the parser at least one task per core.

    A Parquet row group is the smallest scan split; small inputs of big rows
    (one row group of HTML) would otherwise parse in a single task. Inputs whose
    estimated size fills a split for every core, and those of unknown size, are left
    as they are (no shuffle). Only the plan's size estimate is asked; nothing runs.
    """
    cores = pages.sparkSession.sparkContext.defaultParallelism
    size = estimated_bytes(pages)
    if size is not None and size < cores * SPLIT_BYTES:
        return pages.repartition(cores)
    return pages


SPLIT_BYTES = 128 * 1024 * 1024


def page_trees(pages: DataFrame, keep_html: bool = False) -> DataFrame:
    """The rows of ``pages`` with ``nodes`` and ``runs`` in place of ``html`` (kept too on request)."""
    kept = [F.col(c) for c in pages.columns if c not in ("html", "page_id")]
    src = spread_pages(pages).select(F.col("page_id").cast("long").alias("page_id"), *kept,
                                     *([F.col("html").alias("html_")] if keep_html else []), F.col("html"))
    schema = T.StructType(src.schema.fields[:-1] + TREE_FIELDS)
    out = src.mapInArrow(_parse_batches, schema)
    return out.withColumnRenamed("html_", "html") if keep_html else out


def carried(trees: DataFrame) -> list[str]:
    """The columns of the pages that a tree table carries along."""
    return [c for c in trees.columns if c not in ("nodes", "runs")]


# ----------------------------------------------------------------------
# expressions on a page's row
# ----------------------------------------------------------------------

Test = Callable[[Column], Column]


def step_of(node: Column) -> Column:
    return F.when(node["single"], node["tag"]).otherwise(F.concat(node["tag"], F.lit("["), node["tag_pos"].cast("string"), F.lit("]")))


def path_of(node_id: Column) -> Column:
    """The stored path of a node: the steps of all nodes whose subtree holds it, in document
    order. An index is written only where siblings share a tag. Of -1 (no node) the empty path."""
    above = F.filter("nodes", lambda n: (n["id"] <= node_id) & (n["end"] >= node_id))
    return F.when(node_id < 0, F.lit("")).otherwise(F.concat(F.lit("/"), F.array_join(F.transform(above, step_of), "/")))


def parent_paths(found: Column) -> Column:
    """Map from the parents of the ``found`` nodes to their paths: siblings share one look-up."""
    parents = F.array_distinct(F.transform(found, lambda n: n["parent"]))
    return F.map_from_arrays(parents, F.transform(parents, path_of))


def text_of(node: Column) -> Column:
    return F.when(node["has_text"], F.get("runs", node["lo"])).otherwise(F.lit(""))


def tail_of(node: Column) -> Column:
    return F.when(node["has_tail"], F.get("runs", node["hi"])).otherwise(F.lit(""))


def node_runs(node: Column) -> Column:
    """The text runs of a node's subtree (its own tail excluded)."""
    return F.slice("runs", node["lo"] + 1, node["hi"] - node["lo"])


def inner_text(node: Column) -> Column:
    """All text under a node, joined by a space, white space collapsed and trimmed."""
    return inner_trim(F.array_join(node_runs(node), " "))


def attr(node: Column, name: str) -> Column:
    return node["attrs"].getItem(name)


ROW_COLUMNS = ["page_id", "node_id", "parent_id", "end_id", "depth", "tag", "sib_pos", "tag_pos", "prev_id", "attrs", "text", "tail", "src_start", "src_end"]


def _row(n: Column) -> list[Column]:
    return [n["id"].alias("node_id"), n["parent"].alias("parent_id"), n["end"].alias("end_id"), n["depth"].alias("depth"), n["tag"].alias("tag"),
            n["sib_pos"].alias("sib_pos"), n["tag_pos"].alias("tag_pos"), n["prev"].alias("prev_id"), n["attrs"].alias("attrs"),
            text_of(n).alias("text"), tail_of(n).alias("tail"), n["src_start"].alias("src_start"), n["src_end"].alias("src_end")]


def node_rows(trees: DataFrame, test: Test | None = None, path: bool = False, text: bool = False) -> DataFrame:
    """One row per element (those that meet ``test``): ROW_COLUMNS, on request with ``xpath`` and with
    ``node_text`` (C1), which are built for these nodes only."""
    found = F.filter("nodes", test) if test is not None else F.col("nodes")
    cols = carried(trees)
    src = trees.select(*cols, "nodes", "runs", found.alias("_found"))
    if path:
        src = src.withColumn("_paths", parent_paths(F.col("_found")))

    def row(n):
        more = [F.concat(F.element_at("_paths", n["parent"]), F.lit("/"), step_of(n)).alias("xpath")] if path else []
        return F.struct(*_row(n), *more, *([inner_text(n).alias("node_text")] if text else []))
    return src.select("page_id", F.inline(F.transform("_found", row)))


# ----------------------------------------------------------------------
# C2 / C3 element search
# ----------------------------------------------------------------------

def _tag_test(tag: str | None, name: str | None, value: str | None) -> Test:
    def test(n):
        cond = F.lit(True)
        if tag:
            cond = cond & (n["tag"] == tag)
        if name and value:
            cond = cond & F.coalesce(attr(n, name).rlike("(?i)" + value), F.lit(False))
        return cond
    return test


def find_by_tag(trees: DataFrame, tag: str | None = None, attr: str | None = None, value: str | None = None,
                start: Test | None = None) -> DataFrame:
    """Elements by tag and/or attribute, with their paths.

    The attribute value is an unanchored, case-insensitive regular expression, as in the
    reference's search. The search runs from the document root, or from every node that
    meets ``start``: then ``start_id`` names it, and a node below several of them is found from each.
    A start node itself is excluded only when a tag is given.
    """
    test = _tag_test(tag, attr, value)
    if start is None:
        return node_rows(trees, lambda n: test(n) & ((n["parent"] >= 0) if tag else F.lit(True)), path=True)
    # one pass for the hits, then those within each start node's interval
    hits, src = F.filter("nodes", test), trees
    src = src.withColumn("_hits", hits).withColumn("_paths", parent_paths(F.col("_hits")))
    src = src.withColumn("_starts", F.filter("nodes", start))
    within = F.flatten(F.transform("_starts", lambda s: F.transform(
        F.filter("_hits", lambda n: ((n["id"] > s["id"]) if tag else (n["id"] >= s["id"])) & (n["id"] <= s["end"])),
        lambda n: F.struct(s["id"].alias("start_id"), *_row(n), F.concat(F.element_at("_paths", n["parent"]), F.lit("/"), step_of(n)).alias("xpath")))))
    return src.select("page_id", F.inline(within))


def css_select(trees: DataFrame, tag: str, attr_name: str | None = None, value: str | None = None, op: str = "=") -> DataFrame:
    """The selector forms in use, ``tag``, ``tag[attr=value]`` (exact), ``tag[attr*=value]`` (contains)
    and ``tag[attr~=value]`` (a word of it), with their paths."""
    def test(n):
        cond = n["tag"] == tag
        if attr_name is None:
            return cond
        a = attr(n, attr_name)
        if op == "=":
            met = a == value
        elif op == "*=":
            met = a.contains(value)
        elif op == "~=":
            met = F.array_contains(F.split(a, r"\s+"), value)
        else:
            raise ValueError("unsupported selector operator " + op)
        return cond & F.coalesce(met, F.lit(False))
    return node_rows(trees, test, path=True)


# ----------------------------------------------------------------------
# C5-C8 navigation
# ----------------------------------------------------------------------

def parent_path(path_col):
    """C5 path: cut a trailing ``/@attr`` and then the last step."""
    no_attr = F.regexp_replace(path_col, r"(/@.*)$", "")
    return F.regexp_replace(no_attr, r"/[^/]*$", "")


def node_parent(trees: DataFrame, test: Test | None = None) -> DataFrame:
    """The nodes (that meet ``test``) which have a parent, with its number, tag and path."""
    met = F.filter("nodes", lambda n: (n["parent"] >= 0) & (test(n) if test is not None else F.lit(True)))
    src = trees.withColumn("_found", met).withColumn("_paths", parent_paths(F.col("_found")))
    # parents with their tags, once each
    src = src.withColumn("_tags", F.map_from_arrays(F.map_keys("_paths"), F.transform(F.map_keys("_paths"), lambda p: F.get("nodes", p)["tag"])))

    def row(n):
        up = F.element_at("_paths", n["parent"])
        return F.struct(*_row(n), F.concat(up, F.lit("/"), step_of(n)).alias("xpath"), F.element_at("_tags", n["parent"]).alias("parent_tag"), up.alias("parent_xpath"))
    return src.select("page_id", F.inline(F.transform("_found", row)))


def node_children(trees: DataFrame) -> DataFrame:
    """Child elements with their order among siblings."""
    return node_rows(trees, lambda n: n["parent"] >= 0).select("page_id", "parent_id", "sib_pos", "node_id", "tag", "text", "tail")


def text_runs(trees: DataFrame) -> DataFrame:
    """Children including loose text as pseudo ``text`` elements.

    For each parent: its leading text, then each child element followed by
    the child's tail, in order. ``run_pos`` orders the runs in a parent.
    """
    kind = "array<struct<parent_id:int,run_pos:int,kind:string,node_id:int,run_text:string>>"
    none = F.lit(None).cast("int")
    inner = F.col("parent_id") >= 0
    lead = F.struct(F.col("node_id").alias("parent_id"), F.lit(0).alias("run_pos"), F.lit("text").alias("kind"), none.alias("node_id"), F.col("text").alias("run_text"))
    elem = F.struct("parent_id", (F.col("sib_pos") * 2 - 1).alias("run_pos"), F.col("tag").alias("kind"), "node_id", F.col("text").alias("run_text"))
    tail = F.struct("parent_id", (F.col("sib_pos") * 2).alias("run_pos"), F.lit("text").alias("kind"), none.alias("node_id"), F.col("tail").alias("run_text"))
    each = F.array_compact(F.array(F.when(F.col("text") != "", lead), F.when(inner, elem), F.when(inner & (F.col("tail") != ""), tail)).cast(kind))
    return node_rows(trees).select("page_id", F.inline(each))


def prev_sibling(trees: DataFrame, test: Test | None = None) -> DataFrame:
    """The nearest preceding sibling element (null for the first)."""
    met = F.filter("nodes", test) if test is not None else F.col("nodes")

    def row(n):
        before = F.get("nodes", n["prev"])
        return F.struct(n["id"].alias("node_id"), n["parent"].alias("parent_id"), n["tag"].alias("tag"), n["sib_pos"].alias("sib_pos"),
                        before["id"].alias("prev_id"), before["tag"].alias("prev_tag"))
    return trees.select("page_id", F.inline(F.transform(met, row)))


# ----------------------------------------------------------------------
# C11-C13 tree edits: trees to trees, where the page lies
# ----------------------------------------------------------------------

def _edit(change, most_nodes: int = 1 << 12):
    """Arrow task: the last column names the nodes to remove; ``change`` edits one page's tree. The rows of a batch are taken
    apart in slices that end with the page that reaches ``most_nodes``, so Python holds no more than that and one page at a time."""
    def task(batches):
        for batch in batches:
            names = batch.schema.names[:-1]
            at_nodes, at_runs = names.index("nodes"), names.index("runs")
            ends = batch.column(at_nodes).offsets
            first = 0
            for i in range(batch.num_rows):
                if ends[i + 1].as_py() - ends[first].as_py() < most_nodes and i + 1 < batch.num_rows:
                    continue
                part = batch.slice(first, i + 1 - first)
                nodes, runs, gone = (part.column(k).to_pylist() for k in (at_nodes, at_runs, part.num_columns - 1))
                trees = [change(n, r, set(g)) for n, r, g in zip(nodes, runs, gone, strict=True)]
                cols = list(part.columns[:-1])
                cols[at_nodes], cols[at_runs] = _tree_arrays(trees)
                yield pa.RecordBatch.from_arrays(cols, names=names)
                first = i + 1
                del part, nodes, runs, gone, trees, cols
    return task


def _texts(nodes: list[dict], runs: list[str]) -> tuple[list[str], list[str]]:
    return [runs[n["lo"]] if n["has_text"] else "" for n in nodes], [runs[n["hi"]] if n["has_tail"] else "" for n in nodes]


def _kept_tree(nodes: list[dict], texts: list[str], tails: list[str], keep: list[int], parent: list[int], renumber: bool) -> Tree:
    def col(name):
        return [nodes[i][name] for i in keep]
    depth: list[int] = []
    at: dict[int, int] = {}
    for i in keep:
        at[nodes[i]["id"]] = len(depth)
        depth.append(depth[at[parent[i]]] + 1 if parent[i] in at else 0)
    tree = Tree(col("id"), [parent[i] for i in keep], col("end"), depth, col("tag"), [list(dict(a).items()) for a in col("attrs")],
                [texts[i] for i in keep], [tails[i] for i in keep], col("src_start"), col("src_end"))
    if not renumber:  # paths stay those of the raw tree
        tree.sib_pos, tree.tag_pos, tree.single = col("sib_pos"), col("tag_pos"), col("single")
    return tree


def _without_subtrees(nodes: list[dict], runs: list[str], gone: set[int]) -> Tree:
    texts, tails = _texts(nodes, runs)
    place = {n["id"]: i for i, n in enumerate(nodes)}
    last_kept: dict[int, int] = {}
    keep: list[int] = []
    until = -1  # the subtree being removed ends here
    for i, n in enumerate(nodes):
        if n["id"] <= until:
            continue
        if n["id"] not in gone:
            keep.append(i)
            last_kept[n["parent"]] = i
            continue
        until = n["end"]
        up = place.get(n["parent"], -1)
        if tails[i] and up >= 0:
            side, where = (tails, last_kept[n["parent"]]) if n["parent"] in last_kept else (texts, up)
            side[where] = f"{side[where]} {tails[i]}" if side[where] else tails[i]
    return _kept_tree(nodes, texts, tails, keep, [n["parent"] for n in nodes], renumber=False)


def _without_tags(nodes: list[dict], runs: list[str], gone: set[int]) -> Tree:
    texts, tails = _texts(nodes, runs)
    new_texts, new_tails = [""] * len(nodes), [""] * len(nodes)
    place = {n["id"]: i for i, n in enumerate(nodes)}
    parent = [n["parent"] for n in nodes]
    keep: list[int] = []
    last: dict[int, int] = {}  # the last kept child so far of a kept node
    open_at: list[int] = []

    def put(up: int, text: str):
        """Text at the present place under a kept node: behind its last kept child, or its own."""
        if text and up >= 0:
            if up in last:
                new_tails[last[up]] += text
            else:
                new_texts[place[up]] += text

    def close(i: int):
        put(parent[i], tails[i])

    for i, n in enumerate(nodes):
        while open_at and nodes[open_at[-1]]["end"] < n["id"]:
            close(open_at.pop())
        up = place.get(parent[i], -1)
        if up >= 0 and nodes[up]["id"] in gone:
            parent[i] = parent[up]  # a removed parent already points to its kept one
        if n["id"] in gone:
            put(parent[i], texts[i])
        else:
            keep.append(i)
            new_texts[i] = texts[i]
            if parent[i] >= 0:
                last[parent[i]] = i
        open_at.append(i)
    while open_at:
        close(open_at.pop())
    roots = [i for i in keep if parent[i] < 0 and nodes[i]["id"] not in gone]
    for i in roots:
        new_tails[i] = tails[i]
    return _kept_tree(nodes, new_texts, new_tails, keep, parent, renumber=True)


def _edited(trees: DataFrame, test: Test, change) -> DataFrame:
    marked = trees.withColumn("_gone", F.transform(F.filter("nodes", test), lambda n: n["id"]))
    return marked.mapInArrow(_edit(change), trees.schema)


def drop_subtree(trees: DataFrame, test: Test) -> DataFrame:
    """C11: remove the nodes that meet ``test`` with their content but keep each removed
    root's tail: it is joined by a space to the tail of the nearest kept
    preceding sibling, or to the parent's text when there is none.

    One sweep in document order; node numbers and paths stay those of the raw tree.
    """
    return _edited(trees, test, _without_subtrees)


def drop_tag(trees: DataFrame, test: Test) -> DataFrame:
    """Remove the tag of the nodes that meet ``test`` but keep their children and
    text, as an element tree's tag drop does:

    * every node's parent becomes its nearest kept ancestor;
    * a removed element's text is appended to the tail of the last kept
      child of that ancestor before it, else to the ancestor's text; its tail goes the same
      way (so after its last child when it had one); text of a removed root goes with it;
    * siblings are counted anew, so paths are those of the edited tree.

    One sweep in document order.
    """
    return _edited(trees, test, _without_tags)


def junk_test(n: Column) -> Column:
    return (n["tag"].isin(CLEAN_DROP_TAGS)
            | F.coalesce(attr(n, "class").rlike(CLEAN_AD_PATTERN), F.lit(False))
            | F.coalesce(attr(n, "id").rlike(CLEAN_AD_PATTERN), F.lit(False)))


def clean_doc(trees: DataFrame, unwrap_inline: bool = False) -> DataFrame:
    """The cleaned trees.

    Removes script/style/nav/footer/aside/form/noscript subtrees and
    elements whose class or id names an ad (C11). With ``unwrap_inline``
    the inline wrappers (b, i, em, strong, span, br) are then unwrapped
    (C12), merging their text into the surrounding runs. By default they
    stay: body scoring reads each block's whole text either way, and skips the nodes that
    the parser found inside junk.
    """
    cleaned = drop_subtree(trees, junk_test)
    return drop_tag(cleaned, lambda n: n["tag"].isin(CLEAN_UNWRAP_TAGS)) if unwrap_inline else cleaned


# ----------------------------------------------------------------------
# C10 serialisation
# ----------------------------------------------------------------------

def node_html(trees: DataFrame, test: Test) -> DataFrame:
    """C10 for the raw tree: the source markup of the nodes that meet ``test``, from the start of its start
    tag to the end of its end tag (or the point where it was implicitly closed). ``trees`` must carry
    the HTML (``page_trees(..., keep_html=True)``)."""
    found = F.transform(F.filter("nodes", test), lambda n: F.struct(
        n["id"].alias("node_id"), F.substring(F.col("html"), n["src_start"] + 1, n["src_end"] - n["src_start"]).alias("node_html")))
    return trees.select("page_id", F.inline(found))


def _escaped(c: Column, quotes: bool = False) -> Column:
    c = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.replace(c, F.lit('"'), F.lit("&quot;")) if quotes else c


# Elements whose text is not markup.
RAW_TEXT_TAGS = ["script", "style"]


def serialised(trees: DataFrame, test: Test) -> DataFrame:
    """C10 for any tree, an edited one too: markup of the nodes that meet ``test``, from their opening and closing events in
    document order. Parsed again it gives the same elements, attributes and texts."""
    def markup(root):
        inside = F.filter("nodes", lambda n: (n["id"] >= root["id"]) & (n["id"] <= root["end"]))

        def events(n):
            void = n["tag"].isin(*sorted(VOID_TAGS))
            attrs = F.array_join(F.transform(F.map_entries(n["attrs"]), lambda a: F.concat(F.lit(" "), a["key"], F.lit('="'), _escaped(a["value"], True), F.lit('"'))), "")
            text = F.when(n["tag"].isin(RAW_TEXT_TAGS), text_of(n)).otherwise(_escaped(text_of(n)))
            tail = F.when(n["id"] == root["id"], F.lit("")).otherwise(_escaped(tail_of(n)))
            opening = F.concat(F.lit("<"), n["tag"], attrs, F.lit(">"), text)
            closing = F.concat(F.when(void, F.lit("")).otherwise(F.concat(F.lit("</"), n["tag"], F.lit(">"))), tail)
            # an element closes behind its last descendant, the inner one first
            return F.array(F.struct(n["id"].alias("at"), F.lit(0).alias("closes"), F.lit(0).alias("inner"), opening.alias("piece")),
                           F.struct(n["end"].alias("at"), F.lit(1).alias("closes"), (-n["id"]).alias("inner"), closing.alias("piece")))
        return F.array_join(F.transform(F.sort_array(F.flatten(F.transform(inside, events))), lambda e: e["piece"]), "")
    return trees.select("page_id", F.inline(F.transform(F.filter("nodes", test), lambda n: F.struct(n["id"].alias("node_id"), markup(n).alias("node_html")))))
