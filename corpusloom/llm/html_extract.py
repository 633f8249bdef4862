"""Main text of web pages by wrapper induction.

Every page is parsed into a tree.  Its containers are slots, known by the labels
on the way to them.  Over all pages of a host, a slot weighs as much as the
different texts that fill it, links left out: what is constant counts once, what
varies from page to page counts each time.  The main part of a page is found by
walking from the body into the slot that holds at least half of what its parent
holds, until none does or an article is reached.  The weights are the host's, so
a page whose article is shorter than its advert is read as its neighbours are.
Slots on fewer than ``LEAST_PAGES`` different pages have no weight of the host;
there the page's own texts decide, those with an article or main element first.

Inside the main part simple tree matching aligns one representative of each
layout of a host with those of larger ones, and layouts that mostly match are one
class.  A block, its (place, text) pair, is template if at least ``LEAST_PAGES``
pages have it and these are at least ``SHARE`` of the pages of its layout class,
or of all pages of the host that have any text at its place.  The rest is content.
Pages of the same texts count once.

Tags and roles (menus, footers, sidebars, forms) remove an element anywhere.
Names remove a container only where a whole class or id says so; parts of names
merely keep it from weighing when the main part is looked for.  An article inside
an article is a reader's, and of several articles in one slot the longest is the
page's, unless none has half of their text; other elements in one slot are parts
of a text.  Texts of the main element that lie
around its article, and containers there that hold its title, belong to it.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, table, written

#: A template block stands on so many pages, and on such a share of those it could stand on.
LEAST_PAGES, SHARE = 3, 0.5
#: Layouts whose trees match to this share are one class.
ALIKE = 0.7
#: Wrappers of all hosts go to every task up to this size; beyond it they are joined by host.
BROADCAST_BYTES = 32 << 20
#: Deeper elements are not aligned.
DEEPEST = 60
#: A slot is entered if it has this share of what its parent has.
DOMINANT = 0.5
#: Of several elements in one slot all are parts of the text, unless one has this share (of articles: the share above).
WHOLE = 0.9

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)/?(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript iframe template title svg object noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Elements that an opening tag of these closes first, if open within the nearest of the given scopes.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}), "option": ({"option"}, {"select"}),
}
PLAIN_TEXT_SCOPE = frozenset({"table", "td", "th", "article", "section", "div", "li", "body", "blockquote", "main", "aside", "nav", "footer", "header", "form"})

# Elements, roles and class words of what is not the article.
AWAY_TAGS = frozenset("nav footer aside form head dialog menu button select search".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
AWAY_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu sidebar"
    " footer masthead topbar breadcrumb breadcrumbs cookie cookies consent gdpr notice notices popup modal overlay newsletter"
    " subscribe subscription signup login share sharing social related recommended recommendations widget comment comments"
    " commentlist respond disqus replies pagination pager toolbar skip".split()
)
#: Elements that lay out a page; the others are part of a text.
CONTAINERS = frozenset("address article aside body center dialog div fieldset footer form header hgroup html main menu nav search section".split())
#: Elements that a name can remove.
NAMED = CONTAINERS | {"ul", "ol", "dl", "table", "iframe"}
#: Away only outside an article.
PAGE_HEADER = frozenset({"header"})


class Node:
    """An element; ``kids`` are elements and texts, ``label`` its tag and classes; ``light`` ones do not weigh."""

    __slots__ = ("tag", "label", "kids", "away", "header", "main", "light")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.kids = tag, []
        self.label, self.away, self.light = tag, tag in AWAY_TAGS, False
        self.header, self.main = tag in PAGE_HEADER, tag == "main"
        if attributes and not attributes.isspace():
            found = {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(attributes)}
            names = (found.get("class", "") + " " + found.get("id", "")).lower()
            if found.get("class"):
                self.label = f"{tag}.{'.'.join(sorted(found['class'].split()))}"
            role = found.get("role", "").lower()
            self.main = self.main or role == "main"
            if tag not in ("html", "body", "article", "main"):
                self.away = self.away or role in AWAY_ROLES
                if tag in NAMED:
                    whole = set(names.split())
                    self.away = self.away or bool(whole & AWAY_WORDS)
                    self.header = self.header or "header" in whole
                    self.light = bool(set(WORDS.findall(names)) & AWAY_WORDS)
            if "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower():
                self.away = True


def parse(html: str) -> Node:
    """The element tree of a page; missing and stray end tags are mended as browsers do."""
    root = Node("#root")
    open_ = [root]
    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            open_[-1].kids.append(html[at:])
            break
        if m.start() > at:
            open_[-1].kids.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
                # An inline end tag does not close the block around it.
                if tag not in BLOCK and open_[k].tag in BLOCK:
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else n
            open_[-1].kids.append(" ")
            continue
        if tag in BLOCK:
            _close(open_, {"p"}, PLAIN_TEXT_SCOPE)
        if tag in CLOSES:
            _close(open_, *CLOSES[tag])
        node = Node(tag, m[3])
        open_[-1].kids.append(node)
        if tag not in VOID and not (m[0].endswith("/>") and tag not in BLOCK):
            open_.append(node)
    return root


def _close(open_: list[Node], tags: set[str], scope) -> None:
    low = None
    for k in range(len(open_) - 1, 0, -1):
        if open_[k].tag in tags:
            low = k
        elif open_[k].tag in scope:
            break
    if low is not None:
        del open_[low:]


def _in_order(root: Node):
    """("in" or "out", node) and ("text", text) in page order, without recursion."""
    stack: list[tuple[str, object]] = [("in", root)]
    while stack:
        what, x = stack.pop()
        yield what, x
        if what == "in":
            stack.append(("out", x))
            stack.extend(("text", k) if isinstance(k, str) else ("in", k) for k in reversed(x.kids))


class Slot:
    """A container of a page: its way from the root as a number, the texts in it, and the slots in it."""

    __slots__ = ("node", "key", "up", "kids", "own", "weight", "text", "article", "title")

    def __init__(self, node: Node, up: Slot | None = None):
        self.node, self.up, self.kids = node, up, []
        self.key = 0 if up is None else _number(up.key, node.label)
        self.own = self.weight = self.text = 0
        self.article, self.title = node.tag == "article", False


def _number(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(map(str, parts))) - (1 << 63)


def slots_of(root: Node) -> Slot:
    """The page's slots below its body, or below the root without one.

    ``weight`` counts the characters in a slot that stand in no link, ``own``
    those in no slot further in, of which ``text`` is a number.  What tags, roles or
    whole names remove is no slot.
    """
    bodies = [x for what, x in _in_order(root) if what == "in" and x.tag == "body"]
    top = Slot(bodies[0] if bodies else root)
    line, away, link, light = [top], 0, 0, 0
    for what, x in _in_order(top.node):
        if what == "text":
            if not away and not link and not light:
                n = len("".join(x.split()))
                line[-1].own += n
                if n:
                    line[-1].text = _number(line[-1].text, x)
            continue
        if x is top.node:
            continue
        closing = what == "out" and line[-1].node is x
        in_article = (x.tag == "article" or x.header) and any(s.article for s in (line[:-1] if closing else line))
        gone = x.away or (in_article if x.tag == "article" else x.header and not in_article)
        container = x.tag in CONTAINERS and not gone
        if what == "in":
            away += gone
            link += x.tag == "a"
            light += x.light
            if container and not away:
                line.append(Slot(x, line[-1]))
            if x.tag == "h1" and not away:
                line[-1].title = True
        else:
            if closing:
                done = line.pop()
                done.weight += done.own
                line[-1].kids.append(done)
                line[-1].weight += done.weight
                line[-1].title |= done.title
            away -= gone
            link -= x.tag == "a"
            light -= x.light
    top.weight += top.own
    return top


def slots_within(top: Slot) -> list[Slot]:
    out, stack = [], [top]
    while stack:
        s = stack.pop()
        out.append(s)
        stack.extend(s.kids)
    return out


def _leading(top: Slot) -> set[int]:
    """The slots, by identity, that are an article or main element or have one in them."""
    out: set[int] = set()
    for s in reversed(slots_within(top)):  # those further in first
        if s.article or s.node.main or any(id(k) in out for k in s.kids):
            out.add(id(s))
    return out


def choose(top: Slot, weights: dict[int, float]) -> tuple[list[Slot], list[Slot], list[Slot]]:
    """The slots of the main part, all on the way to it, and of these those from the main element on, outermost first."""
    now, line, way, in_main, holding = top, [], [], top.node.main, None
    while not now.article and now.kids:
        groups: dict[int, list[Slot]] = {}
        for s in now.kids:
            groups.setdefault(s.key, []).append(s)
        page = {key: sum(s.weight for s in g) for key, g in groups.items()}
        if any(key in weights for key in groups):
            score, whole = {key: weights.get(key, 0.0) for key in groups}, weights.get(now.key, 0.0)  # the sum of what is in it
        else:
            score, whole = page, float(now.weight)
            if holding is None:
                holding = _leading(top)
            some = {key: score[key] for key, g in groups.items() if any(id(s) in holding for s in g)}
            if some:
                score, whole = some, float(sum(some.values()))
        best = max(score, key=lambda key: (score[key], page[key]))
        if score[best] < DOMINANT * whole or not whole and len(groups) > 1:
            break
        line.append(now)
        if in_main:
            way.append(now)
        alike = groups[best]
        longest = max(alike, key=lambda s: s.weight)
        if longest.weight < (DOMINANT if longest.article else WHOLE) * page[best]:
            return alike, line, way
        now = longest
        in_main = in_main or now.node.main
    return [now], line, way


def blocks(html: str | None, weights: dict[int, float] = {}) -> list[tuple[str, str]]:
    """(place, text) of the blocks of the page's main part, in order: white space as one space, trimmed.

    ``weights`` are those of the host's slots; without any the page decides.
    """
    return main_blocks(slots_of(parse(html or "")), weights)[1]


def layout_and_blocks(html: str | None, weights: dict[int, float] = {}) -> tuple[tuple[str, ...], list[tuple[str, str]]]:
    """The page's layout, as its frame and the different containers of its blocks in order, and its blocks."""
    frame, found = main_blocks(slots_of(parse(html or "")), weights)
    # A label starts with its tag.
    inside = ("/".join(s for s in place.split("/")[:DEEPEST] if s.split(".", 1)[0] in CONTAINERS) for place, _ in found)
    return ("/".join(frame[:DEEPEST]), *dict.fromkeys(inside)), found


def main_blocks(top: Slot, weights: dict[int, float]) -> tuple[list[str], list[tuple[str, str]]]:
    """The labels on the way to the main part, and its blocks in page order; places begin at the main part."""
    mains, line, way = choose(top, weights)
    main, to_main, around = ({id(s.node) for s in part} for part in (mains, line, way))
    # Around the main part: texts in no slot, and slots with a title, inside the main element.
    titles = {id(k.node) for s in way for k in s.kids if k.title} - main - to_main
    frame: list[str] = []
    out: list[tuple[str, str]] = []
    path: list[str] = []
    text: list[str] = []
    outer: list[list[str]] = []
    away, inside, near, articles, framed = 0, 0, 0, 0, False

    def flush():
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                out.append(("/".join(path), joined))
            text.clear()

    for what, x in _in_order(top.node):
        if what == "text":
            if not away and (inside or near):
                text.append(x)
            continue
        at_main = id(x) in main
        gone = False
        if not at_main and x is not top.node:
            gone = x.away or (x.header and not articles) or (x.tag == "article" and articles > (what == "out"))
            # Slots that do not lead to the main part are passed by.
            gone = gone or (x.tag in CONTAINERS and not inside and near < 2 and id(x) not in to_main and id(x) not in titles)
        edge = x.tag in BLOCK or gone or at_main
        if what == "out" and edge:
            flush()
        if what == "in":
            if edge:
                flush()
            if at_main:
                if not framed:
                    frame, framed = list(path), True
                outer.append(path)
                path = []
                inside += 1
            away += gone
            near += (id(x) in around) + 2 * (id(x) in titles)
            articles += x.tag == "article"
            if x.tag in BLOCK:
                path.append(x.label)
            elif x.tag == "br" and not away:
                text.append(" ")
        else:
            if x.tag in BLOCK:
                path.pop()
            away -= gone
            near -= (id(x) in around) + 2 * (id(x) in titles)
            articles -= x.tag == "article"
            if at_main:
                path = outer.pop()
                inside -= 1
    flush()
    return frame, out


def tree_of(found: list[tuple[str, str]]) -> tuple[str, list]:
    """The blocks as a tree of (label, children); a child that is a number is the block's place in the list."""
    root: tuple[str, list] = ("", [])
    line = [root]
    labels: list[str] = []
    for k, (place, _) in enumerate(found):
        steps = place.split("/")[:DEEPEST]
        same = 0
        # Sibling blocks of one label are elements of their own, so the last step always opens anew.
        while same < min(len(labels), len(steps) - 1) and labels[same] == steps[same]:
            same += 1
        del line[same + 1 :]
        for s in steps[same:]:
            node: tuple[str, list] = (s, [])
            line[-1][1].append(node)
            line.append(node)
        labels = steps
        line[-1][1].append(k)
    return root


def _name(node, texts: list, names: dict, of: dict) -> int:
    """A number that equal subtrees, texts included, share; kept in ``of`` by identity."""
    if isinstance(node, int):
        return names.setdefault(("", texts[node][1]), len(names))
    found = names.setdefault((node[0], *(_name(k, texts, names, of) for k in node[1])), len(names))
    of[id(node)] = found
    return found


def _leaves(node) -> list[int]:
    return [node] if isinstance(node, int) else [k for kid in node[1] for k in _leaves(kid)]


def _weight(node) -> float:
    return 4.0 if isinstance(node, int) else 1.0 + sum(_weight(k) for k in node[1])


def simple_tree_matching(a: tuple[str, list], b: tuple[str, list], x: list, y: list) -> tuple[float, list[tuple[int, int]]]:
    """The weight of the best order-preserving matching below two nodes, and its pairs of blocks.

    Blocks of the same text weigh more, so that what is constant aligns.  No
    subtree matches another one better than an equal one, so equal ones at both
    ends of two lists of children are matched at once; of the rest only those of
    the same label are compared.
    """
    names: dict = {}
    of: dict[int, int] = {}
    _name(a, x, names, of)
    _name(b, y, names, of)

    def name(node, texts: list) -> int:
        return names["", texts[node][1]] if isinstance(node, int) else of[id(node)]

    def match(a, b) -> tuple[float, list[tuple[int, int]]]:
        if isinstance(a, int):
            return (4.0 if x[a][1] == y[b][1] else 1.0), [(a, b)]
        p, q = a[1], b[1]
        low, high = 0, 0
        most = min(len(p), len(q))
        while low < most and name(p[low], x) == name(q[low], y):
            low += 1
        while high < most - low and name(p[-1 - high], x) == name(q[-1 - high], y):
            high += 1
        ends = [*zip(p[:low], q[:low]), *(zip(p[-high:], q[-high:]) if high else ())]
        total = 1.0 + sum(_weight(k) for k, _ in ends)
        pairs = [z for k, m in ends for z in zip(_leaves(k), _leaves(m))]
        by_label: dict[str, list[int]] = {}
        for j in range(len(q) - high - 1, low - 1, -1):
            by_label.setdefault("" if isinstance(q[j], int) else q[j][0], []).append(j)
        # The heaviest rising chain of (i, j), by a tree of prefix maxima over j.
        size = len(q) - high - low
        best: list[tuple[float, int]] = [(0.0, -1)] * (size + 1)
        chain: list[tuple[int, list]] = []
        for i in range(low, len(p) - high):
            for j in by_label.get("" if isinstance(p[i], int) else p[i][0], ()):
                w, inner = match(p[i], q[j])
                before, k = (0.0, -1), j - low
                while k > 0:
                    before = max(before, best[k])
                    k -= k & -k
                chain.append((before[1], inner))
                here, k = (before[0] + w, len(chain) - 1), j - low + 1
                while k <= size:
                    best[k] = max(best[k], here)
                    k += k & -k
        top, k = (0.0, -1), size
        while k > 0:
            top = max(top, best[k])
            k -= k & -k
        at = top[1]
        while at >= 0:
            pairs += chain[at][1]
            at = chain[at][0]
        return total + top[0], pairs

    return match(a, b) if a[0] == b[0] else (0.0, [])


def block_key(place: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{place}\0{text}") - (1 << 63)


def layout_tree(layout: tuple[str, ...]) -> tuple[str, list]:
    """The containers as a tree within the frame."""
    tree = tree_of([(place, "") for place in layout[1:]])
    for label in reversed(layout[0].split("/")):
        tree = label, [tree]
    return tree


def layout_classes(layouts: list[tuple[int, int, str]]) -> list[int]:
    """For each (key, pages, layout) of a host the key of its class: the first of those with more pages that it mostly matches, else its own."""
    out: dict[int, int] = {}
    heads: list[tuple[int, set, tuple, float]] = []
    for key, _, text in sorted(layouts, key=lambda x: (-x[1], x[0])):
        places = tuple(text.split("\n"))
        tree, mine = layout_tree(places), set(places)
        x = [(p, "") for p in places[1:]]
        whole = simple_tree_matching(tree, tree, x, x)[0]
        for head, others, other, weight in heads:
            # Without a container in common the trees hardly match.
            if mine & others:
                y = [("", "")] * len(others)
                if 2 * simple_tree_matching(tree, other, x, y)[0] >= ALIKE * (whole + weight):
                    out[key] = head
                    break
        else:
            out[key] = key
            heads.append((key, mine, tree, whole))
    return [out[key] for key, _, _ in layouts]


def _bounded(df: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast if it is small."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def slot_weights(pages: DataFrame) -> DataFrame:
    """(host, slots): for each host of at least ``LEAST_PAGES`` different pages, how much each slot on so many pages weighs.

    A slot weighs what the different texts in it weigh, each counted in the slot
    it stands in and in all around that.  Tasks give a row for each slot of a
    page; equal texts of a slot are joined before they are added up, so copies and
    constants weigh once.
    """

    def batches(it):
        for batch in it:
            rows, hosts = [], []
            for k, html in enumerate(batch.column("html")):
                found = slots_within(slots_of(parse(html.as_py() or "")))
                # The body stands for the whole page, so that different pages can be counted.
                page = _number(*sorted((s.key, s.text) for s in found))
                for s in found:
                    keys, up = [s.key], s.up
                    while s.own and up is not None:
                        keys.append(up.key)
                        up = up.up
                    rows.append((s.key, page if s.up is None else s.text, s.own, keys))
                hosts += [k] * len(found)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host").take(pa.array(hosts, pa.int64())), *(pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds))],
                ["host", "key", "text", "own", "keys"],
            )

    filled = pages.select("host", "html").mapInArrow(batches, "host string, key long, text long, own long, keys array<long>")
    texts = durable(filled.groupBy("host", "key", "text").agg(F.max("own").alias("own"), F.first("keys").alias("keys"), F.count("*").alias("n")))
    seen = texts.groupBy("host", "key").agg(F.sum("n").alias("n"), F.count("*").alias("different")).where(F.col("n") >= LEAST_PAGES)
    hosts = seen.where((F.col("key") == 0) & (F.col("different") >= LEAST_PAGES)).select("host")
    weights = texts.select("host", F.explode("keys").alias("key"), "own").groupBy("host", "key").agg(F.sum("own").alias("weight"))
    slots = weights.join(seen.select("host", "key"), ["host", "key"]).join(hosts, "host")
    return slots.groupBy("host").agg(F.collect_list(F.struct("key", "weight")).alias("slots"))


class Weights:
    """The slot weights of the hosts of a batch, each made once."""

    def __init__(self, batch: pa.RecordBatch):
        self.column, self.host, self.known = batch.column("slots"), batch.column("host").to_pylist(), {}

    def of(self, k: int) -> dict[int, float]:
        host = self.host[k]
        if host not in self.known:
            self.known[host] = {x["key"]: float(x["weight"]) for x in self.column[k].as_py() or ()}
        return self.known[host]


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, template, by_layout) for each host with a template: keys of blocks that are template on all its pages, and by key of the layout."""

    def batches(it):
        for batch in it:
            rows, weights = [], Weights(batch)
            for k, html in enumerate(batch.column("html")):
                layout, found = layout_and_blocks(html.as_py(), weights.of(k))
                keys = {block_key(place, text): block_key(place, "") for place, text in found}
                texts = "\0".join(t for _, t in found)
                rows.append((block_key("", texts), "\n".join(layout), list(keys), list(keys.values())))
            page, layout, keys, places = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host"), pa.array(page, pa.int64()), pa.array([block_key("", x) for x in layout], pa.int64()), pa.array(layout, pa.string()),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64())),
                ],
                ["host", "page", "layout", "shape", "keys", "places"],
            )

    found = pages.select("host", "html", "slots").mapInArrow(batches, "host string, page long, layout long, shape string, keys array<long>, places array<long>")
    page = F.min(F.struct("layout", "shape", "keys", "places")).alias("p")
    different = written(found.where(F.size("keys") > 0).groupBy("host", "page").agg(page).select("host", "p.*"))
    one = different.select("host", "layout", F.explode(F.arrays_zip("keys", "places")).alias("b")).select("host", "layout", "b.keys", "b.places")
    per_layout = durable(one.groupBy("host", "layout", "keys", "places").agg(F.count("*").alias("n")))

    holding = different.select("host", F.explode(F.array_distinct("places")).alias("places")).groupBy("host", "places").agg(F.count("*").alias("of"))
    holding = durable(holding.where(F.col("of") >= LEAST_PAGES))
    anywhere = per_layout.groupBy("host", "keys", "places").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_PAGES)
    anywhere = anywhere.join(_bounded(holding, 64), ["host", "places"]).where(F.col("n") >= SHARE * F.col("of")).select("host", F.col("keys").alias("key"))
    anywhere = durable(anywhere)

    def one_host(t: pa.Table) -> pa.Table:
        classes = layout_classes(list(zip(t.column("layout").to_pylist(), t.column("pages").to_pylist(), t.column("shape").to_pylist())))
        return t.select(["host", "layout", "pages"]).append_column("class", pa.array(classes, pa.int64()))

    # A layout of fewer pages has no class; its pages count where their places do.
    layouts = different.groupBy("host", "layout").agg(F.count("*").alias("pages"), F.min("shape").alias("shape")).where(F.col("pages") >= LEAST_PAGES)
    layouts = durable(layouts.groupBy("host").applyInArrow(one_host, "host string, layout long, pages long, class long"))
    sizes = layouts.groupBy("host", "class").agg(F.sum("pages").alias("of"))
    classes = durable(layouts.join(sizes, ["host", "class"]).select("host", "layout", "class", "of"))
    inside = per_layout.join(_bounded(classes, 64), ["host", "layout"]).groupBy("host", "class", "of", F.col("keys").alias("key")).agg(F.sum("n").alias("n"))
    inside = inside.where((F.col("n") >= LEAST_PAGES) & (F.col("n") >= SHARE * F.col("of"))).join(anywhere, ["host", "key"], "left_anti")
    inside = inside.groupBy("host", "class").agg(F.collect_list("key").alias("keys")).join(classes, ["host", "class"])
    inside = inside.groupBy("host").agg(F.collect_list(F.struct("layout", "keys")).alias("by_layout"))
    return anywhere.groupBy("host").agg(F.collect_list("key").alias("template")).join(inside, "host", "full_outer")


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    Null and empty pages give an empty text.  Pages without a host in their url,
    or with a null one, share the empty host.  Repeated rows give repeated
    results; other columns are ignored.  Of slots that weigh the same the one with
    more text on the page is entered; layouts with as many pages are taken in the
    order of their keys.  Very long pages are read as a whole.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    slots = durable(slot_weights(rows))
    weighed = slots.agg(F.sum(F.length("host") + 16 * F.size("slots"))).first()[0] or 0
    rows = rows.join(F.broadcast(slots) if weighed <= BROADCAST_BYTES else slots, "host", "left")
    wrapper = durable(wrappers(rows))
    layered = F.aggregate("by_layout", F.lit(0), lambda n, x: n + 1 + F.size(x["keys"]))
    size = wrapper.agg(F.sum(F.length("host") + 8 * (F.coalesce(F.size("template"), F.lit(0)) + F.coalesce(layered, F.lit(0))))).first()[0] or 0
    joined = rows.join(F.broadcast(wrapper) if size <= BROADCAST_BYTES else wrapper, "host", "left")

    def batches(it):
        for batch in it:
            texts, known, weights = [], {}, Weights(batch)
            for k, (host, html) in enumerate(zip(batch.column("host").to_pylist(), batch.column("html"))):
                if host not in known:  # one wrapper for each host of the batch
                    inside = {x["layout"]: x["keys"] for x in batch.column("by_layout")[k].as_py() or ()}
                    known[host] = set(batch.column("template")[k].as_py() or ()), inside
                template, inside = known[host]
                layout, found = layout_and_blocks(html.as_py(), weights.of(k))
                if inside:
                    template = template.union(inside.get(block_key("", "\n".join(layout)), ()))
                texts.append("\n".join(t for place, t in found if not template or block_key(place, t) not in template))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.select("page_id", "url", "html", "host", "slots", "template", "by_layout").mapInArrow(batches, "page_id long, url string, text string, n_chars long")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
