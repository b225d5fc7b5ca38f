"""HTML extraction by wrapper induction.

Pages are read into trees of block elements; neighbours of one shape are one node. The pages of a host are aligned by simple tree matching
(the order-preserving matching of equal nodes with the most pairs, by dynamic programming over the children in linear
space) and merged into one template tree. Tasks merge the pages they meet, exact copies once; partial templates of a host are folded in
rounds, so that a host with a third of all pages is no task's burden. Then every page is aligned with its host's template, and facts of each node are summed
over the host's differing pages (those with the same texts at the same nodes are copies and count as one): how many pages reach it, how many
neighbours it stands for, its share of the page's text without links, whether it holds blocks; and how many pages hold each text at it.

The template decides in two ways. From the top it goes down while one child, alone of its shape, holds blocks (with hardly any text beside them) and at least half of the text on
pages that nearly all reach it: what stands beside that path is template whatever its words, and the node where it ends is the content root, the slot that varies in
structure. Inside it a text that the share ``SHARE`` of the differing pages hold at one node is template too, unless all pages together have less text of
their own there than one page has: then they are near copies of one text. For extraction a page is aligned once more and keeps the slots of the content root. Element names break the ties that alignment leaves:
a heading or an article element ends the way down, named adverts and comments are no content root, inside it slots in navigation, advert, form and comment elements are no content, and where it has article elements
(or else main elements) the others are their neighbours. On pages without a content root (a host of one page, or of pages that differ in all) names alone decide. What is left is the main text, in page order and whatever its size.

A partial template of at least 64 pages forgets nodes that fewer than an eighth of them reach. No template text is lost by that: a node that
``SHARE`` of a host's pages reach is reached by that share of the pages of one partial template at least, and merging keeps it.

Nulls, empties and ties: a null or empty html gives an empty text; a null or malformed url belongs to
the nameless host; a page whose slots are all template text (a host of copies) keeps that text; elements nested deeper than ``DEEPEST`` belong to the
element at that depth, with all their text; repeated rows are extracted alike; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as html_
import pickle
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm.common import partitions_of, written, written_at
from registrylake.llm.encode import row_chunks

KNOWN = ("template", "fixed", "facts", "pages")
TEXT = "struct<node: int, digest: long, chars: long>"
FACT = "struct<node: int, pages: long, members: long, share: long, inner: long, named: long, chars: long>"
RESULT = "page_id long, url string, host string, text string, n_chars long"
SHARE, SHIP_BYTES, BUCKET_BYTES, RANGE_BYTES, FAN_IN, DEEPEST = 0.7, 64 << 20, 16 << 20, 128 << 20, 32, 250
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
sys.setrecursionlimit(max(sys.getrecursionlimit(), 40 * DEEPEST))
_TAG = re.compile(r"""<(?:!--(?:.*?(?:-->|\Z))|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*'|["'])*)(?:>|\Z))""", re.DOTALL)
_ATTR = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "fieldset", "audio", "video"}
NO_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
NO_NAME = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "sidebar", "widget", "widgets", "related", "recommended", "share", "sharing", "social", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "footer", "header", "masthead", "toolbar", "subscribe", "newsletter", "signup", "login", "search", "form", "copyright", "hidden"}
#: Opening one of these ends an open element of the same set entry.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


#: Of these only names that tell comments, adverts and the like apart count on an article, and none on the others.
FRAMES = {"html", "body", "main"}
HARD_NAME = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "related", "recommended", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "newsletter", "subscribe", "signup"}
LAYOUT = re.compile(r"\b(?:has|with|no|without|show|hide)[-_ ]?(?:left|right)?[-_ ]?[a-z]+")
KEPT, INHERITED, SOFT, HARD = range(4)


class Node:
    """``why``: why the element is no content; a soft reason yields to an article inside. ``links``: characters of its own text in links."""

    __slots__ = ("tag", "sig", "why", "kids", "links", "runs", "shape", "group")

    def __init__(self, tag: str, sig: str, why: int):
        self.tag, self.sig, self.why, self.kids, self.links, self.runs, self.shape, self.group = tag, sig, why, [], 0, [], 0, None

    @property
    def skip(self) -> bool:
        return self.why != KEPT


def _opened(tag: str, attrs: str, above: bool) -> Node:
    why, sig = (SOFT if tag == "form" else HARD if tag in ASIDE else KEPT), tag
    if attrs and not attrs.isspace():
        names = []
        for key, *values in _ATTR.findall(attrs):
            key, value = key.lower(), next((v for v in values if v), "").lower()
            if key in ("class", "id"):
                names.append(re.sub(r"\d+", "0", value))
                told = set(re.split(r"[^a-z]+", LAYOUT.sub(" ", value))) if tag not in FRAMES else set()
                if not HARD_NAME.isdisjoint(told):
                    why = HARD
                elif tag != "article" and not NO_NAME.isdisjoint(told):
                    why = max(why, SOFT)
            elif key == "role" and value in NO_ROLE and tag not in FRAMES:
                why = HARD
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                why = HARD
        if names:
            sig = f"{tag}.{' '.join(names)}"
    return Node(tag, sig, why or (INHERITED if above else KEPT))


def _freed(node: Node, stack: list) -> None:
    """An article in an element that only its name or a form speaks against: that element is a frame of the page."""
    if node.why == INHERITED and all(n.why != HARD for n in stack):
        for n in [*stack, node]:
            n.why = KEPT


def parse(page: str | None) -> Node:
    """Tree of block elements; their kids are nodes, and strings for runs of text."""
    root = Node("#", "#", KEPT)
    stack, run, at, page = [root], [], 0, page or ""
    hidden, linked = 0, False  # depth of inline elements that are boilerplate; inside a link

    def flush() -> None:
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                stack[-1].kids.append(text)

    while True:
        m = _TAG.search(page, at)
        piece = page[at : m.start() if m else len(page)]
        if piece and not hidden:
            run.append(html_.unescape(piece) if "&" in piece else piece)
            if linked:
                stack[-1].links += len(piece)
        if not m:
            break
        at = m.end()
        close, tag, attrs = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not close:
            if not attrs.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in VOID or tag in RAW:
            run.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in INLINE:
            if tag == "a":
                linked = not close
            if hidden:
                hidden += -1 if close else 1
            elif not close and attrs and _opened(tag, attrs, False).skip:
                hidden = 1
            continue
        flush()
        hidden, linked = 0, False
        if close:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        ends = ENDS.get(tag, {"p"} if tag not in ("body", "html") else ())
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in ends:
                del stack[i:]
                break
            if stack[i].tag not in ("p", "li", "td", "th", "dt", "dd", "tr", "option"):
                break
        node = _opened(tag, attrs, stack[-1].skip)
        if tag in ("article", "main"):
            _freed(node, stack)
        if len(stack) > DEEPEST and node.skip == stack[-1].skip:
            node.kids = stack[-1].kids  # nested beyond sense: its text joins its parent's
        else:
            stack[-1].kids.append(node)
        if not attrs.endswith("/"):
            stack.append(node)
    flush()
    shaped(root)
    return root


def shaped(node: Node) -> None:
    """Sets ``shape`` and ``runs``, the neighbours of one shape. Two equal elements that hold blocks may be a text and what stands beside it; three are a list."""
    found: list = []
    for k in node.kids:
        if isinstance(k, str):
            continue
        shaped(k)
        if found and found[-1][0].shape == k.shape:
            found[-1].append(k)
        else:
            found.append([k])
    for run in found:
        node.runs += [[k] for k in run] if len(run) == 2 and run[0].runs else [run]
    node.shape = hash((node.sig, *(run[0].shape for run in node.runs)))


class Group:
    """Neighbours of one shape as one node: signature, members, child groups; ``shape`` and ``size`` of the tree of groups."""

    __slots__ = ("sig", "members", "kids", "match", "shape", "size", "own", "mass")

    def __init__(self, sig: str, members: list):
        self.sig, self.members, self.match, self.own, self.mass = sig, members, None, 0, 0
        for m in members:
            m.group = self
        self.kids = [Group(place[0][0].sig, [k for run in place for k in run]) for place in zip(*(m.runs for m in members))]
        measure(self)

    def weigh(self) -> int:
        """Sets ``own`` and ``mass``: the characters outside links here, and here and below."""
        self.own = max(0, sum(sum(len(k) for k in m.kids if isinstance(k, str)) - m.links for m in self.members))
        self.mass = self.own + sum(k.weigh() for k in self.kids)
        return self.mass


class Template:
    """A template node: signature, pages that reached it, children; its number (in preorder) and its template texts once it is complete."""

    __slots__ = ("sig", "pages", "kids", "shape", "size", "number", "fixed")

    def __init__(self, sig: str, pages: int, kids: list):
        self.sig, self.pages, self.kids, self.number, self.fixed = sig, pages, kids, -1, set()
        measure(self)

    def dump(self) -> bytes:
        """Signature, pages and number of children of the nodes in preorder."""
        flat = list(self.nodes())
        return pickle.dumps(([t.sig for t in flat], [t.pages for t in flat], [len(t.kids) for t in flat]))

    def nodes(self):
        stack = [self]
        while stack:
            t = stack.pop()
            yield t
            stack += reversed(t.kids)

    @classmethod
    def load(cls, data: bytes) -> "Template":
        done: list = []
        for sig, pages, kids in zip(*(reversed(x) for x in pickle.loads(data))):
            done.append(cls(sig, pages, [done.pop() for _ in range(kids)]))
        return done[0]


def measure(node) -> None:
    node.shape = hash((node.sig, *(k.shape for k in node.kids)))
    node.size = 1 + sum(k.size for k in node.kids)


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def as_template(g: Group) -> Template:
    return Template(g.sig, 1, [as_template(k) for k in g.kids])


_SIZES: dict = {}


def pair_size(x, y) -> int:
    """Matched nodes of two trees whose roots have one signature."""
    if x.shape == y.shape:
        return x.size
    key = (x.shape, y.shape)
    if key not in _SIZES:
        if len(_SIZES) > 200_000:
            _SIZES.clear()
        _SIZES[key] = 1 + matching(x.kids, y.kids)[0]
    return _SIZES[key]


def _row(weights: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The last row of the table of best sums: of all of ``a`` with each beginning of ``b``."""
    best = np.zeros(len(b) + 1, np.int64)
    for i in a.tolist():
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + weights[i][b]))
    return best


def matching(a: list, b: list) -> tuple[int, list]:
    """Simple tree matching of two lists of children: size and matched pairs of positions.

    Equal trees at either end are matched at once (no other matching is larger). The table between them is made row by
    row, and the pairs are found by halving, so that space is linear in the lists.
    """
    lo, n, m = 0, len(a), len(b)
    while lo < min(n, m) and a[lo].shape == b[lo].shape:
        lo += 1
    while min(n, m) > lo and a[n - 1].shape == b[m - 1].shape:
        n, m = n - 1, m - 1
    pairs = [(i, i) for i in range(lo)]
    tail = [(n + k, m + k) for k in range(len(a) - n)]
    total = sum(a[i].size for i, _ in pairs) + sum(a[i].size for i, _ in tail)
    names = [x.sig for x in a[lo:n]]
    if names and n > lo and m > lo:
        if names == [y.sig for y in b[lo:m]] and len(set(names)) == len(names):  # nothing else can match
            between = [(i, i) for i in range(lo, n)]
            total += sum(pair_size(a[i], b[i]) for i, _ in between)
        else:
            size, between = _between(a[lo:n], b[lo:m])
            total, between = total + size, [(i + lo, j + lo) for i, j in between]
        pairs += between
    return total, pairs + tail


def _between(a: list, b: list) -> tuple[int, list]:
    kinds_a, kinds_b = {}, {}
    at = np.array([kinds_a.setdefault(x.shape, (len(kinds_a), x))[0] for x in a])
    bt = np.array([kinds_b.setdefault(y.shape, (len(kinds_b), y))[0] for y in b])
    weights = np.zeros((len(kinds_a), len(kinds_b)), np.int64)
    for i, x in kinds_a.values():
        for j, y in kinds_b.values():
            if x.sig == y.sig:
                weights[i, j] = pair_size(x, y)
    pairs, total, todo = [], 0, [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        if k == i or m == j:
            continue
        if k - i == 1:
            own = weights[at[i]][bt[j:m]]
            best = int(np.argmax(own))
            if own[best]:
                pairs.append((i, j + best))
                total += int(own[best])
            continue
        half = (i + k) // 2
        cut = j + int(np.argmax(_row(weights, at[i:half], bt[j:m]) + _row(weights, at[half:k][::-1], bt[j:m][::-1])[::-1]))
        todo += [(half, k, cut, m), (i, half, j, cut)]
    return total, sorted(pairs)


def merge(into: Template, other: Template) -> None:
    """Adds a template of the same signature to ``into``."""
    into.pages += other.pages
    matched = {j: i for i, j in matching(into.kids, other.kids)[1]}
    kids, at = [], 0
    for j, kid in enumerate(other.kids):
        if j in matched:
            kids += into.kids[at : matched[j] + 1]
            at = matched[j] + 1
            merge(kids[-1], kid)
        else:
            kids.append(kid)
    into.kids = kids + into.kids[at:]
    measure(into)


def forget(template: Template, least: float) -> None:
    """Drops the nodes that fewer than ``least`` pages reached."""
    template.kids = [k for k in template.kids if k.pages >= least]
    for k in template.kids:
        forget(k, least)
    measure(template)


class Known:
    """What extraction needs of a host: the template, its nodes numbered, with their template texts, and the content root."""

    __slots__ = ("template", "root")

    def __init__(self, template: Template, root: Template | None):
        self.template, self.root = template, root


def content_root(template: Template, facts: dict, pages: int) -> Template | None:
    """Where the way down through children that hold the most text ends (see above); None if it does not leave the top or there is one page only."""
    node = template
    while pages > 1 and node.sig.partition(".")[0] != "article":
        known = [(facts[k.number], k) for k in node.kids if k.number in facts and facts[k.number]["pages"] >= SHARE * pages]
        fits = [(f["share"], k) for f, k in known if f["members"] <= 1.1 * f["pages"] and 2 * f["inner"] >= f["pages"] and 2 * f["named"] < f["pages"]]
        share, best = max(fits, key=lambda x: x[0], default=(0, None))
        if best is None or not share or 2 * share < facts[node.number]["share"] or any(k.sig.partition(".")[0] in HEADINGS for _, k in known):
            break
        node = best
    return None if node is template else node


def loaded(data: bytes | None, fixed: list | None, facts: list | None, pages: int | None) -> Known | None:
    """A stored template with the template texts ``fixed`` (node, digest, characters on all pages) and the ``facts`` of its nodes, sums over the host's differing ``pages``."""
    if data is None:
        return None
    template = Template.load(data)
    flat = list(template.nodes())
    for number, t in enumerate(flat):
        t.number = number
    of = {f["node"]: f for f in facts or ()}
    root = content_root(template, of, pages or 0) if 0 in of else None
    top = root or template
    inside = lambda f: top.number <= f["node"] < top.number + top.size
    constant, total = (sum(f["chars"] for f in x if inside(f)) for x in (fixed or (), facts or ()))
    if (pages or 0) * (total - constant) >= total:  # together the pages have a page's worth of their own
        for f in fixed or ():
            flat[f["node"]].fixed.add(f["digest"])
    return Known(template, root)


def align(group: Group, template: Template) -> None:
    group.match = template
    for i, j in matching(template.kids, group.kids)[1]:
        align(group.kids[j], template.kids[i])


def _matched(node: Node) -> Template | None:
    return None if node.group is None else node.group.match


def _constant(node: Node, text: str) -> bool:
    t = _matched(node)
    return t is not None and bool(t.fixed) and digest(text) in t.fixed


def _held(node: Node, above: int, out: set, chars: dict) -> None:
    """(number of the template node or -1, digest, length) of the texts below a node outside boilerplate; ``chars``: their length by the nearest template node."""
    t = _matched(node)
    number, near = (-1, above) if t is None else (t.number, t.number)
    for k in node.kids:
        if isinstance(k, str):
            text = (number, digest(k), len(k))
            if text not in out:
                out.add(text)
                chars[near] = chars.get(near, 0) + len(k)
        elif not k.skip:
            _held(k, near, out, chars)


def facts_of(group: Group, chars: dict) -> list:
    """Of each template node that a page reaches: 1, the members of its group, its share of the page's text in thousandths, whether it holds blocks and hardly any text of its own, whether its name speaks against it, characters of its own."""
    whole, out, todo = max(1, group.weigh()), [], [group]
    while todo:
        g = todo.pop()
        if g.match is not None:
            named = any(m.why == HARD for m in g.members)
            out.append({"node": g.match.number, "pages": 1, "members": len(g.members), "share": 1000 * g.mass // whole, "inner": int(bool(g.kids) and 20 * g.own <= g.mass), "named": int(named), "chars": chars.get(g.match.number, 0)})
            todo += g.kids
    return sorted(out, key=lambda f: f["node"])


def _slots(node: Node, out: list) -> None:
    """(text, is template) of the texts below a node, but for boilerplate below it, in page order."""
    for k in node.kids:
        if isinstance(k, str):
            out.append((k, _constant(node, k)))
        elif k.why < SOFT:
            _slots(k, out)


def _regions(node: Node, root: Template, out: list) -> None:
    """The elements that are matched with the content root."""
    for k in node.kids:
        if not isinstance(k, str):
            if _matched(k) is root:
                out.append(k)
            else:
                _regions(k, root, out)


def _articles(node: Node, tag: str, out: list) -> None:
    if node.tag == tag:
        out.append(node)
        return
    for k in node.kids:
        if not isinstance(k, str) and k.why < SOFT:
            _articles(k, tag, out)


def extract(page: str | None, known: Known | None) -> str:
    """Main text of a page; ``known`` is what ``loaded`` gives for its host."""
    top = parse(page)
    group = Group("#", [top])
    regions: list = []
    if known is not None:
        align(group, known.template)
        if known.root is not None:
            _regions(top, known.root, regions)
    regions = regions or [top]
    roots: list = []
    for tag in ("article", "main"):
        for r in regions if not roots else ():
            _articles(r, tag, roots)
    slots: list = []
    for r in roots or regions:
        _slots(r, slots)
    kept = [t for t, fixed in slots if not fixed]
    return " ".join(kept if kept else [t for t, _ in slots])


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/:?#]+)", 1))


def induce(pages: DataFrame, most_nodes: int = 200_000) -> DataFrame:
    """host, template (dumped) from all ``pages`` (host, html); a task holds about ``most_nodes`` nodes of partial templates."""

    def learn(batches):
        held: dict = {}
        met: set = set()
        part = TaskContext.get().partitionId() << 24

        def out() -> pa.RecordBatch:
            nonlocal part
            part += 1
            for t in held.values():
                if t.pages >= 64:
                    forget(t, t.pages / 8)
            made = pa.RecordBatch.from_pydict({"host": pa.array(list(held), pa.string()), "part": pa.array([part] * len(held), pa.int64()), "template": pa.array([t.dump() for t in held.values()], pa.binary())})
            held.clear()
            met.clear()
            return made

        size = 0
        for batch in (p for b in batches for p in row_chunks(b, 1)):
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = digest(f"{host}\n{page}")
                if key in met:
                    continue
                met.add(key)
                new = as_template(Group("#", [parse(page)]))
                size += new.size
                if host in held:
                    merge(held[host], new)
                else:
                    held[host] = new
                if size > most_nodes:  # merged nodes were counted twice; look again
                    size = sum(t.size for t in held.values())
                    if size > most_nodes // 2 or len(met) > most_nodes:
                        yield out()
                        size = 0
        if held:
            yield out()

    def join(table: pa.Table) -> pa.Table:
        total = None
        for data in table.column("template").to_pylist():
            t = Template.load(data)
            if total is None:
                total = t
            else:
                merge(total, t)
        return pa.table({"host": table.column("host")[:1], "part": table.column("part")[:1], "template": pa.array([total.dump()], pa.binary())})

    schema = "host string, part long, template binary"
    parts = written(pages.select("host", "html").mapInArrow(learn, schema), "partial-trees")
    while True:  # a round leaves 2 of FAN_IN partial templates of the host that has most
        most = parts.groupBy("host").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= FAN_IN:
            return parts.groupBy("host").applyInArrow(join, schema).select("host", "template")
        dealt = parts.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(-(-most * 2 // FAN_IN))))
        parts = written(dealt.groupBy("host", "part").applyInArrow(join, schema), "partial-trees")


def with_templates(pages: DataFrame, templates: DataFrame, ship_bytes: int, make, schema: str) -> DataFrame:
    """``make`` of batches (page_id, url, host, html) and what is known of their pages' hosts, for all ``pages``.

    Templates of at most ``ship_bytes`` are broadcast. More of them are a table in the shared folder, cut by hosts into buckets of about
    ``BUCKET_BYTES``; pages are sorted by bucket and host, so that a task reads a bucket once and no page row carries a template.
    """
    size = F.length("template") + 24 * F.greatest(F.size("fixed"), F.lit(0)) + 56 * F.greatest(F.size("facts"), F.lit(0))
    total = templates.agg(F.sum(size)).first()[0] or 0
    spark = pages.sparkSession
    if total <= ship_bytes:
        got = templates.toArrow()
        shared, folder = spark.sparkContext.broadcast(_by_host(got)), None
        rows = pages.select("page_id", "url", "host", "html", F.lit(0).alias("bucket"))
    else:
        bucket = F.pmod(F.xxhash64("host"), F.lit(total // BUCKET_BYTES + 1)).cast("int")
        shared, folder = None, written_at(templates.withColumn("bucket", bucket).repartition("bucket"), "template-buckets", ["bucket"])[1]
        rows = pages.select("page_id", "url", "host", "html", bucket.alias("bucket"))
        parts = partitions_of(rows, F.length("html"), RANGE_BYTES)
        rows = rows.repartitionByRange(parts, "bucket", "host", F.xxhash64("html")).sortWithinPartitions("bucket", "host")

    def run(batches):
        known: dict = {}
        held, at = (shared.value if shared is not None else {}), 0
        for batch in batches:
            for part in row_chunks(batch, 3, 256):
                met = []
                for host, bucket in zip(part.column(2).to_pylist(), part.column(4).to_pylist()):
                    if host not in known:
                        if folder is not None and (not held or bucket != at):
                            held, at = _by_host(_bucket(folder, bucket)), bucket
                        if len(known) >= 256:
                            known.clear()
                        known[host] = loaded(*held.get(host, (None,) * len(KNOWN)))
                    met.append(known[host])
                yield make(part, met)

    return rows.mapInArrow(run, schema)


def _by_host(table: pa.Table) -> dict:
    return dict(zip(table.column("host").to_pylist(), zip(*(table.column(c).to_pylist() for c in KNOWN))))


def _bucket(path: str, bucket: int) -> pa.Table:
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(f"{path}/bucket={bucket}")
    files = [i.path for i in store.get_file_info(fs.FileSelector(folder)) if i.path.endswith(".parquet")]
    return pa.concat_tables(pq.ParquetFile(store.open_input_file(f)).read(["host", *KNOWN]) for f in files)


def node_facts(pages: DataFrame, templates: DataFrame, ship_bytes: int) -> DataFrame:
    """host, pages, facts, fixed: the host's differing pages, sums of the facts of its template's nodes, and the texts that SHARE of the pages hold at a node, by exact counts."""
    keys = pa.list_(pa.struct([("node", pa.int32()), ("digest", pa.int64()), ("chars", pa.int64())]))
    sums = ("pages", "members", "share", "inner", "named", "chars")
    facts = pa.list_(pa.struct([("node", pa.int32()), *((c, pa.int64()) for c in sums)]))

    def place(part: pa.RecordBatch, met: list) -> pa.RecordBatch:
        texts, of = [], []
        for page, known in zip(part.column(3).to_pylist(), met):
            top, held, chars = parse(page), set(), {}
            group = Group("#", [top])
            if known is not None:
                align(group, known.template)
            _held(top, 0, held, chars)
            texts.append([{"node": n, "digest": d, "chars": c} for n, d, c in sorted(held)])
            of.append(facts_of(group, chars))
        return pa.RecordBatch.from_pydict({"host": part.column(2), "texts": pa.array(texts, keys), "facts": pa.array(of, facts)})

    placed = with_templates(pages, templates, ship_bytes, place, f"host string, texts array<{TEXT}>, facts array<{FACT}>")
    # Copies differ in no text outside boilerplate; the least of their facts stands for all.
    one = written(placed.groupBy("host", "texts").agg(F.min("facts").alias("facts")), "differing-pages")
    total = one.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    summed = one.select("host", F.explode("facts").alias("f")).groupBy("host", "f.node").agg(*[F.sum(f"f.{c}").alias(c) for c in sums])
    summed = summed.groupBy("host").agg(F.collect_list(F.struct("node", *sums)).alias("facts"))
    counts = one.select("host", F.explode("texts").alias("k")).filter("k.node >= 0").groupBy("host", "k.node", "k.digest").agg(F.count(F.lit(1)).alias("n"), F.sum("k.chars").alias("chars"))
    fixed = counts.filter("n >= 2").join(total, "host").filter(F.col("n") >= SHARE * F.col("pages"))
    return total.join(summed, "host", "left").join(fixed.groupBy("host").agg(F.collect_list(F.struct("node", "digest", "chars")).alias("fixed")), "host", "left")


def main_texts(pages: DataFrame, ship_bytes: int = SHIP_BYTES) -> DataFrame:
    """page_id, url, host, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    url = F.col("url").cast("string")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"), F.col("html").cast("string").alias("html"))
    none = {"fixed": F.lit(None).cast(f"array<{TEXT}>"), "facts": F.lit(None).cast(f"array<{FACT}>"), "pages": F.lit(None).cast("long")}
    trees = written(induce(pages).withColumns(none), "trees")
    templates = written(trees.select("host", "template").join(node_facts(pages, trees, ship_bytes), "host", "left").select("host", *KNOWN), "templates")

    def make(part: pa.RecordBatch, met: list) -> pa.RecordBatch:
        texts = [extract(page, known) for page, known in zip(part.column(3).to_pylist(), met)]
        return pa.RecordBatch.from_pydict({"page_id": part.column(0), "url": part.column(1), "host": part.column(2), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return with_templates(pages, templates, ship_bytes, make, RESULT)


def op2_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: main text of every page of ``pages``."""
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
