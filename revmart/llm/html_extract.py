"""Main text of web pages by wrapper induction.

Every page becomes a tree of its block elements; runs of equal leaf siblings
(paragraphs, list items) are one repeated node, so the trees of a host are
few. The most frequent tree of a host is its wrapper; every other tree of the
host is aligned with it by simple tree matching. Per aligned slot the host's
pages are summed up: how many fill it, whether its text is constant, how much
of it is link text. Constant slots and parts marked as menus, adverts, comments
and the like are template wherever they stand. Of the varying rest, what lies
in an article or main element is content and what lies outside is not, unless
the text outside outweighs the landmarks by far; then it is content as well
(link lists are not), and several small articles beside it are teasers. The
verdicts go back to the pages, whose content blocks are written out in order.

Trees, alignments and sums are grouped by (host, tree), with partial sums
before each shuffle, so a host with a third of all pages is spread like any
other; pages are only ever joined with the verdicts of their own tree.

Defined cases: null and empty html give an empty text; a page without a
readable host belongs to the host ''; copies of a page count once for
constancy; repeated rows stay; other columns are ignored unless named in
``keep``; an empty table gives an empty result;
very long pages are read whole.
"""

from __future__ import annotations

import html as _html
import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, table, text_of, vectorised

QUERY_NAME = "op10_html_extract"
# Elements by their part in a page.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html iframe legend li main menu nav noscript
object ol optgroup option p pre section select summary svg table tbody td template tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp noembed noframes".split())
NEVER_TAGS = frozenset("""nav header footer aside form head noscript template iframe object svg select button dialog menu""".split())
LANDMARKS = frozenset("article main".split())
WHOLE_TAGS = frozenset("html body main".split())  # their classes speak of the page ("has-sidebar")
# Words of class, id and role attributes that mark what is not the article.
NEVER_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended share sharing social
comment comments reply replies discussion disqus notice alert cookie cookies consent newsletter subscribe signup login
popup modal overlay toolbar pagination pager form search complementary contentinfo""".split())
CLOSES_P = BLOCK_TAGS - {"button", "object", "option", "optgroup", "select", "svg", "template", "noscript", "iframe", "body", "html", "head"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|[^<]+|<", re.S)
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NODE = "struct<slot:int,chars:long,links:long,digest:long>"
MIN_PAGES, CONSTANT_SHARE, LINK_SHARE = 4, 0.8, 0.5
OUTWEIGHS = 4  # times the varying text of the landmarks that text outside must have to count


class Node:
    __slots__ = ("label", "tag", "kids", "same", "slot")

    def __init__(self, tag: str, label: str):
        self.tag, self.label, self.kids, self.same, self.slot = tag, label, [], [], 0


def _marks(tag_text: str) -> tuple[str, bool]:
    """Class words of a tag for its label, and whether they rule it out."""
    words = []
    for _, a, b, c in ATTR.findall(tag_text):
        words += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c).lower())
    return ".".join(words[:3]), any(w in NEVER_WORDS for w in words)


def parse(page: str) -> tuple[Node, list[tuple[Node, str, int]]]:
    """Tree of block elements and the page's text blocks in order, each with
    its node and the characters of it that are link text."""
    root = Node("#", "#")
    stack, blocks, parts = [root], [], []
    links = anchor = 0
    hidden: list[str] = []  # an inline element that is ruled out, and what is open in it

    def flush():
        nonlocal parts, links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((stack[-1], text, links))
            parts, links = [], 0

    tokens = TOKEN.finditer(page)
    pos_skip = 0
    for m in tokens:
        if m.start() < pos_skip:
            continue
        token = m.group()
        if token[0] != "<" or token == "<":
            if not hidden:
                text = _html.unescape(token)
                parts.append(text)
                if anchor:
                    links += len(text.strip())
            continue
        got = TAG.match(token)
        if not got:
            continue
        tag, closing = got.group(1).lower(), token[1] == "/"
        if hidden and tag in BLOCK_TAGS:
            hidden = []  # an inline element ends where a block begins or ends
        elif hidden and tag not in RAW_TAGS:
            if closing and tag in hidden:
                del hidden[len(hidden) - 1 - hidden[::-1].index(tag):]
            elif not closing and tag not in VOID_TAGS:
                hidden.append(tag)
            continue
        if tag in RAW_TAGS:
            if not closing:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, m.end())
                pos_skip = end.end() if end else len(page)
            continue
        if tag == "br" or tag == "hr":
            flush()
            continue
        if tag == "a":
            anchor = 0 if closing else 1
        if tag in VOID_TAGS:
            continue
        if tag not in BLOCK_TAGS:
            if not closing and not token.endswith("/>") and "=" in token and _marks(token)[1]:
                hidden = [tag]
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag not in ("center",):
                    break
        if tag in SIBLINGS:
            stop = SCOPES.get(tag, {"table"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in stop:
                    break
                if stack[k].tag in SIBLINGS[tag]:
                    del stack[k:]
                    break
        words, ruled_out = _marks(token) if "=" in token else ("", False)
        label = tag + ("." + words if words else "") + ("!" if tag in NEVER_TAGS or ruled_out and tag not in WHOLE_TAGS else "")
        node = Node(tag, label)
        stack[-1].kids.append(node)
        if not token.endswith("/>"):
            stack.append(node)
    flush()
    return root, blocks


def skeleton(root: Node) -> str:
    """The tree as text, equal leaf siblings in a row written once; numbers
    the nodes (``slot``) in the order of that text."""
    out: list[str] = []
    n = 0
    todo: list = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        node.slot = n
        n += 1
        out.append(node.label)
        if not node.kids:
            continue
        kids: list = []
        for kid in node.kids:
            if kids and not kid.kids and not kids[-1][0].kids and kid.label == kids[-1][0].label:
                kids[-1].append(kid)
            else:
                kids.append([kid])
        todo.append(")")
        for run in reversed(kids):
            todo += [" ", run[0]]
            run[0].same = run[1:]
        todo.append("(")
    todo = [root]
    while todo:
        node = todo.pop()
        for same in node.same:
            same.slot = node.slot
        todo += node.kids
    return "".join(out)


def read_skeleton(text: str) -> list[tuple[str, int, list[int]]]:
    """(label, parent, children) of each node, by number."""
    nodes: list[tuple[str, int, list[int]]] = []
    up: list[int] = []
    for t in re.findall(r"[()]|[^() ]+", text):
        if t == "(":
            up.append(len(nodes) - 1)
        elif t == ")":
            up.pop()
        else:
            parent = up[-1] if up else -1
            nodes.append((t, parent, []))
            if parent >= 0:
                nodes[parent][2].append(len(nodes) - 1)
    return nodes


def simple_tree_match(a: list, b: list) -> list[int]:
    """For each node of tree ``a`` its partner in tree ``b`` or -1: a largest
    matching that keeps order and ancestry, roots included."""
    sizes: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], list[list[int]]] = {}
    # Pairs that can meet have equal labels on the whole way up: find them top
    # down, then solve them bottom up.
    pairs, k = [(0, 0)] if a and b and a[0][0] == b[0][0] else [], 0
    while k < len(pairs):
        i, j = pairs[k]
        pairs += [(x, y) for x in a[i][2] for y in b[j][2] if a[x][0] == b[y][0]]
        k += 1
    for i, j in reversed(pairs):
        left, right = a[i][2], b[j][2]
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for x, u in enumerate(left, 1):
            for y, v in enumerate(right, 1):
                best[x][y] = max(best[x - 1][y], best[x][y - 1], best[x - 1][y - 1] + sizes.get((u, v), 0))
        tables[i, j], sizes[i, j] = best, best[-1][-1] + 1
    partner = [-1] * len(a)
    todo = [(0, 0)] if pairs else []
    while todo:
        i, j = todo.pop()
        partner[i] = j
        best, left, right = tables[i, j], a[i][2], b[j][2]
        x, y = len(left), len(right)
        while x and y:
            if best[x][y] == best[x - 1][y]:
                x -= 1
            elif best[x][y] == best[x][y - 1]:
                y -= 1
            else:
                x, y = x - 1, y - 1
                todo.append((left[x], right[y]))
    return partner


def slot_labels(nodes: list) -> list[str]:
    """Per node: 'never' below a part that is ruled out, 'article' below a
    landmark, 'open' elsewhere."""
    out: list[str] = []
    for label, parent, _ in nodes:
        above = out[parent] if parent >= 0 else "open"
        if label.split(".")[0] == "main":
            out.append("article")
        elif label.endswith("!") or above == "never":
            out.append("never")
        elif above == "article" or re.split(r"[.!]", label)[0] in LANDMARKS or ".main" in label:
            out.append("article")
        else:
            out.append("open")
    return out


def slot_regions(nodes: list) -> list[int]:
    """Per node: the number of the outermost article it lies in, 0 elsewhere
    below another landmark, -1 outside of landmarks."""
    out: list[int] = []
    for k, ((label, parent, _), kind) in enumerate(zip(nodes, slot_labels(nodes))):
        above = out[parent] if parent >= 0 else -1
        article = re.split(r"[.!]", label)[0] == "article"
        out.append(above if above > 0 else k if article and kind == "article" else 0 if kind == "article" else -1)
    return out


@vectorised(f"struct<tree:string,nodes:array<{NODE}>>")
def _read(pages: pd.Series) -> pd.DataFrame:
    trees, nodes = [], []
    for page in pages:
        root, blocks = parse(page)
        trees.append(skeleton(root))
        got: dict[int, list] = {}
        for node, text, links in blocks:
            x = got.setdefault(node.slot, [0, 0, xxhash.xxh64()])
            x[0] += len(text)
            x[1] += min(links, len(text))
            x[2].update(text + "\n")
        nodes.append([{"slot": s, "chars": c, "links": n, "digest": h.intdigest() - 2**63} for s, (c, n, h) in sorted(got.items())])
    return pd.DataFrame({"tree": trees, "nodes": nodes})


@vectorised("array<struct<slot:int,partner:int,label:string,region:int>>")
def _align(tree: pd.Series, wrapper: pd.Series) -> pd.Series:
    out = []
    for t, w in zip(tree, wrapper):
        nodes, base = read_skeleton(t), read_skeleton(w)
        labels, regions = slot_labels(nodes), slot_regions(nodes)
        out.append([{"slot": k, "partner": p, "label": labels[k], "region": regions[k]} for k, p in enumerate(simple_tree_match(nodes, base))])
    return pd.Series(out, dtype=object)


@vectorised("string")
def _write(pages: pd.Series, content: pd.Series) -> pd.Series:
    out = []
    for page, slots in zip(pages, content):
        root, blocks = parse(page)
        skeleton(root)
        slots = set() if slots is None else set(slots)
        out.append("\n".join(text for node, text, _ in blocks if node.slot in slots))
    return pd.Series(out, dtype=object)


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def content_slots(pages: DataFrame) -> DataFrame:
    """(host, tree, slots): the content slots of every tree, from
    ``pages(host, html)``."""
    read = pages.select("host", _read("html").alias("r")).select("host", "r.tree", "r.nodes").distinct()
    # Copies of a page count once; what is left is summed up by tree.
    per_tree = checkpointed(
        read.select("host", F.xxhash64("tree").alias("tree_id"), "tree", F.explode_outer("nodes").alias("n"))
        .groupBy("host", "tree_id", "tree", F.coalesce("n.slot", F.lit(-1)).alias("slot"))
        .agg(F.count("*").alias("pages"), F.sum("n.chars").alias("chars"), F.sum("n.links").alias("links"),
             F.min("n.digest").alias("low"), F.max("n.digest").alias("high")))
    trees = per_tree.groupBy("host", "tree_id", "tree").agg(F.max("pages").alias("pages"))
    wrappers = trees.groupBy("host").agg(F.max_by("tree", F.struct("pages", "tree_id")).alias("wrapper"))
    aligned = trees.join(wrappers, "host").select("host", "tree_id", F.explode(_align("tree", "wrapper")).alias("a")) \
        .select("host", "tree_id", "a.slot", "a.partner", "a.label", "a.region")
    aligned = checkpointed(aligned)
    filled = aligned.join(per_tree.drop("tree"), ["host", "tree_id", "slot"])
    own = F.when(F.col("partner") < 0, F.col("tree_id"))  # unmatched slots stay apart, tree by tree
    slots = filled.withColumn("own", own).withColumn("at", F.when(F.col("partner") < 0, F.col("slot")).otherwise(F.col("partner")))
    sums = slots.groupBy("host", F.coalesce("own", F.lit(0)).alias("own"), "at").agg(
        F.sum("pages").alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"),
        F.max(F.when(F.col("low") == F.col("high"), F.col("pages")).otherwise(1)).alias("same"),
        F.min("low").alias("low"), F.max("high").alias("high"))
    constant = (F.col("n") >= MIN_PAGES) & ((F.col("low") == F.col("high")) | (F.col("same") >= CONSTANT_SHARE * F.col("n")))
    menu = F.col("links") > LINK_SHARE * F.col("chars")
    verdicts = sums.select("host", "own", "at", (~constant).alias("varies"), menu.alias("menu"))
    judged = slots.select("host", "tree_id", "slot", "label", "region", "chars", F.coalesce("own", F.lit(0)).alias("own"), "at") \
        .join(verdicts, ["host", "own", "at"]).where((F.col("label") != "never") & F.col("varies"))
    judged = judged.select("host", "tree_id", "slot", "region", "menu", "chars")
    # Varying text of each region of a tree, then the largest article against what lies outside of it.
    weight = F.sum(F.when(F.col("menu"), 0).otherwise(F.col("chars")))
    regions = judged.groupBy("host", "tree_id", "region").agg(weight.alias("weight"), F.collect_list(F.struct("slot", "menu")).alias("of"))
    of = lambda c: F.coalesce(F.max(F.when(c, F.col("weight"))), F.lit(0))
    trees = regions.groupBy("host", "tree_id").agg(
        of(F.col("region") > 0).alias("article"), of(F.col("region") == 0).alias("main"), of(F.col("region") < 0).alias("outside"),
        F.count_if(F.col("region") > 0).alias("articles"), F.collect_list(F.struct("region", "of")).alias("regions"))
    outside = F.col("outside") > OUTWEIGHS * F.greatest("article", "main")
    teasers = (F.col("articles") > 1) & (F.greatest("main", "outside") > OUTWEIGHS * F.col("article"))
    found = trees.select("host", "tree_id", outside.alias("outside"), teasers.alias("teasers"), F.explode("regions").alias("r")) \
        .select("*", F.explode("r.of").alias("s"))
    region = F.col("r.region")
    content = F.when(region > 0, ~F.col("teasers")).when(region < 0, F.col("outside") & ~F.col("s.menu")).otherwise(F.lit(True))
    return found.where(content).groupBy("host", "tree_id").agg(F.collect_set("s.slot").alias("slots"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns of every row and ``text``, its main text."""
    names = [f"in_{i}" for i in range(len(keep))]
    base = pages.select(*[pages[c].alias(n) for c, n in zip(keep, names)], host_of(pages[url_col]).alias("host"), text_of(pages[html_col]).alias("html"))
    slots = checkpointed(content_slots(base.select("host", "html")))
    rows = base.withColumn("tree_id", F.xxhash64(_read("html")["tree"]))
    rows = rows.join(slots, ["host", "tree_id"], "left")
    return rows.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], _write("html", "slots").alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"), keep=("page_id", "url"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


ORACLE_SQL = None
