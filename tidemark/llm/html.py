"""Main text of web pages by wrapper induction.

Pages of one host are parsed into trees of block elements, runs of like siblings folded into one node. Each new tree is aligned with the
host's template by simple tree matching, and the template takes up what it lacks. A block of text that the template finds
at the same node, and unchanged, on nearly all different pages is template; what varies fills slots.

Which slots are content is decided by structure first: from the root down, as long as one container holds most of the host's
varying text that isn't links, the small containers beside it (menus, adverts, teasers, footers) are left out. Elements and
names settle what structure leaves open: parts of menus, forms or comments inside the content, and pages whose text is
too short for one container to stand out. Large hosts are dealt into groups, each with a template of its own; a group is
large enough to tell constants, and its pages are bounded in number and bytes.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import lean, materialize, partitions, small_batches

#: Pages, and characters of html, that share one template.
GROUP_PAGES, GROUP_CHARS = 250, 32 << 20
#: Characters of html for one task: few, until that would make very many tasks, and then more; a task holds one group at a time.
TASK_CHARS, LARGE_TASK_CHARS, MANY_TASKS = 8 << 20, 256 << 20, 50_000
#: A text is template if it is on this share of the different pages that have its node, and inside the content on at least so many.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.8, 4
LINK_SHARE = 0.6
#: A container that holds this share of its parent's varying text rules out the containers beside it that hold less than the second.
DOMINANT, SIDE = 0.6, 0.15
#: Block elements nested deeper than this share the node of the last level; their texts stay blocks of their own.
DEPTH = 100
#: A node with more children than this has them folded by label alone, which bounds the table of a tree match.
WIDTH = 200

_SPECIAL = re.compile(r"[>\"']")
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")

BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul head".split()
)
#: Blocks that hold a piece of running text; structure alone never leaves them out. All other blocks are containers.
TEXTUAL = frozenset("address blockquote caption center dd dt figcaption h1 h2 h3 h4 h5 h6 legend li option p pre summary".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object canvas".split())
#: Elements whose start ends an open element of these kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
#: Elements that an implied end tag doesn't cross.
WALLS = frozenset("html body table td th div section article aside main nav header footer form ul ol dl blockquote fieldset".split())
ASIDE = frozenset("nav footer aside form button select dialog menu search label fieldset head".split())
NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer masthead sidebar aside widget widgets ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations comment comments disqus reply replies respond pagination pager toolbar copyright legal skip form".split()
)
#: Names that begin or end so count too, as in commentlist or sidenav.
STEMS = ("comment", "sidebar", "advert", "cookie", "breadcrumb", "newsletter", "navbar", "navig", "banner", "sponsor", "footer", "disqus", "pagin", "subscri")
TAILS = ("sidebar", "navbar", "topbar", "nav", "menu", "footer", "comments", "adverts", "popup")
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
OWN = frozenset("article post entry content main story body text".split())
#: Elements and names that say that all inside is one article, of which structure leaves nothing out.
WHOLE = frozenset("article main entry story post".split())


class Skeleton:
    """A node of the folded tree of block elements."""

    __slots__ = ("children", "index", "label", "link", "own")

    def __init__(self, label: str, index: int):
        self.label, self.index, self.children = label, index, []
        self.own = self.link = 0  # characters of its own text, and those inside links

    def text(self) -> str:
        return f"{self.label}({''.join(c.text() for c in self.children)})" if self.children else self.label + ";"

    @property
    def textual(self) -> bool:
        return self.label.split(".", 1)[0] in TEXTUAL


@dataclass
class Page:
    """Blocks as (skeleton node, text, characters inside links, ruled out by name, inside an article or main element)."""

    tree: Skeleton
    blocks: list[tuple[int, str, int, bool, bool]] = field(default_factory=list)


class Tokens:
    """Cuts markup into texts, tags and what is skipped, in time linear in its length however broken it is.

    A tag ends at the first > outside quotes; if there is none, at the first > at all; if there is none either, its < is text.
    """

    def __init__(self, source: str):
        self.source, self.dead = source, set()
        self.special = (-1, -1)  # (from, place): no quote or > in between; place -1: none from there on
        self.none: dict[str, int] = {}  # from which place on a character doesn't occur

    def _find(self, c: str, at: int) -> int:
        if at >= self.none.get(c, len(self.source) + 1):
            return -1
        found = self.source.find(c, at)
        if found < 0:
            self.none[c] = at
        return found

    def _next(self, at: int) -> int:
        start, place = self.special
        if not (0 <= start <= at and (place < 0 or at <= place)):
            m = _SPECIAL.search(self.source, at)
            self.special = (at, m.start() if m else -1)
        return self.special[1]

    def tag_end(self, at: int) -> int:
        path = []
        i = at
        while True:
            place = self._next(i)
            if place < 0 or place in self.dead:
                break
            c = self.source[place]
            if c == ">":
                return place
            path.append(place)
            close = self._find(c, place + 1)
            if close < 0:
                break
            i = close + 1
        self.dead.update(path)  # quotes from which no end is reached
        return self._find(">", at)

    def __iter__(self) -> Iterator[tuple[str, str, str, int]]:
        """(kind, name, rest, end): kind is text, open or close; a text's characters are in rest. send() a place to go on from."""
        source, at, end = self.source, 0, len(self.source)
        while at < end:
            lt = source.find("<", at)
            if lt != at:
                stop = lt if lt >= 0 else end
                yield "text", "", source[at:stop], stop
                at = stop
                continue
            if source.startswith("<!--", at):
                close = self._find("-->", at + 4)
                at = close + 3 if close >= 0 else end
                continue
            if source[at + 1 : at + 2] in ("!", "?"):
                close = self._find(">", at)
                if close >= 0:
                    at = close + 1
                    continue
            name = _NAME.match(source, at + 1)
            stop = self.tag_end(name.end()) if name else -1
            if stop < 0:
                yield "text", "", "<", at + 1
                at += 1
                continue
            move = yield ("close" if name[1] else "open"), name[2].lower(), source[name.end() : stop], stop + 1
            at = stop + 1 if move is None else move


def _names(attributes: dict[str, str]) -> list[str]:
    """Words of class and id; what follows has, with, no or without only tells of other elements."""
    found = []
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        for word in re.split(r"[^a-z]+", name):
            if word in ("has", "with", "no", "without"):
                break
            if word:
                found.append(word)
    return found


def fold(root: Skeleton, size: int) -> list[Skeleton]:
    """Folds neighbouring containers of one label and shape, and the children of very wide nodes by label. Returns the node for each old index."""
    place: list[Skeleton] = [root] * size

    def onto(kept: Skeleton, gone: Skeleton) -> None:
        place[gone.index] = kept
        named = {c.label: c for c in kept.children}
        for c in gone.children:
            if c.label in named:
                onto(named[c.label], c)
            else:
                kept.children.append(c)
                named[c.label] = c

    def same(kept: Skeleton, gone: Skeleton) -> None:
        place[gone.index] = kept
        for a, b in zip(kept.children, gone.children, strict=True):
            same(a, b)

    def shaped(node: Skeleton) -> str:
        place[node.index] = node
        shapes, kept = [], []
        for c in node.children:
            shape = shaped(c)
            if kept and shapes[-1] == shape:
                same(kept[-1], c)
            else:
                kept.append(c)
                shapes.append(shape)
        if len(kept) > WIDTH:
            first: dict[str, Skeleton] = {}
            for c in kept:
                if c.label in first:
                    onto(first[c.label], c)
                else:
                    first[c.label] = c
            kept, shapes = list(first.values()), [c.label for c in first.values()]
        node.children = kept
        mark = "L" if node.link > LINK_SHARE * node.own else ""
        return f"{node.label}{mark}({''.join(shapes)})"

    shaped(root)
    for i in range(size):  # a node folded away may have been folded onto one that was folded away later
        while place[place[i].index] is not place[i]:
            place[i] = place[place[i].index]
    return place


def parse(source: str) -> Page:
    """Parses any text; broken markup gives the tree that browsers would give, nearly."""
    root = Skeleton("", 0)
    page, count = Page(root), 1
    # open elements: tag, skeleton node, ruled out, in article
    stack: list[tuple[str, Skeleton, bool, bool]] = [("", root, False, False)]
    levels: dict[int, int] = {0: 0}  # of nodes
    places: dict[str, int] = {}  # of open elements by tag, so that a stray end tag needs no search
    buffer: list[str] = []
    links, linked = 0, 0

    def flush():
        nonlocal linked
        text = " ".join("".join(buffer).split())
        if text:
            _, node, out, inside = next(x for x in reversed(stack) if x[0] in BLOCK or not x[0])
            node.own += len(text)
            node.link += min(linked, len(text))
            page.blocks.append((node, text, linked, out, inside))
        buffer.clear()
        linked = 0

    def cut(i: int) -> None:
        nonlocal links
        for x in stack[i:]:
            links -= x[0] == "a"
            places[x[0]] -= 1
        del stack[i:]

    tokens = iter(Tokens(source))
    move = None
    while True:
        try:
            kind, tag, rest, at = tokens.send(move)
        except StopIteration:
            break
        move = None
        if kind == "text":
            text = html.unescape(rest) if "&" in rest else rest
            buffer.append(text)
            if links:
                linked += len(text)
            continue
        if kind == "close":
            if tag in BLOCK:
                flush()
            if not places.get(tag):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    if any(x[0] in BLOCK for x in stack[i:]):
                        flush()
                    cut(i)
                    break
                if tag not in BLOCK and stack[i][0] in BLOCK:
                    break
            continue
        if tag in RAW:
            if not rest.rstrip().endswith("/"):
                close = re.compile(f"</{tag}\\s*>", re.I).search(source, at)
                move = close.end() if close else len(source)
            continue
        if tag in VOID:
            if tag == "br":
                buffer.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            flush()
            shut = CLOSES.get(tag, set()) | ({"p"} if tag not in ("option",) else set())
            if any(places.get(x) for x in shut):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in shut:
                        cut(i)
                        if tag not in ("tr", "tbody", "tfoot", "thead"):
                            break
                    elif stack[i][0] in WALLS and stack[i][0] not in shut:
                        break
        attributes = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(rest)} if rest.strip() else {}
        _, node, out, inside = stack[-1]
        names = _names(attributes)
        inside = inside or tag in ("article", "main") or attributes.get("role") in ("main", "article")
        if not out and tag not in ("html", "body", "main"):
            named = any(n in NAMES or n.startswith(STEMS) or n.endswith(TAILS) for n in names) or ("header" in names and not inside and not OWN.intersection(names))
            hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", ""))
            out = bool(tag in ASIDE or (tag == "header" and not inside) or (named and tag != "article") or attributes.get("role") in ROLES or hidden)
        if tag in BLOCK:
            label = tag + "".join("." + n for n in names[:3])
            level = levels[node.index]
            if level < DEPTH and tag in TEXTUAL and node.children and node.children[-1].label == label:
                node = node.children[-1]
            elif level < DEPTH:
                node.children.append(Skeleton(label, count))
                node, count = node.children[-1], count + 1
                levels[node.index] = level + 1
        elif out and not stack[-1][2]:  # an inline element that is ruled out breaks the block around it
            flush()
        if tag == "a":
            links += 1
        places[tag] = places.get(tag, 0) + 1
        stack.append((tag, node, out, inside))
    flush()
    place = fold(root, count)
    page.blocks = [(place[n.index].index, *rest) for n, *rest in page.blocks]
    return page


def match(a: Skeleton, b: Skeleton, memo: dict | None = None) -> int:
    """Simple tree matching: most pairs of nodes with equal labels that keep order and parents."""
    memo = {} if memo is None else memo
    key = (id(a), id(b))
    if key not in memo:
        memo[key] = 0 if a.label != b.label else 1 + _table(a, b, memo)[-1][-1]
    return memo[key]


def _table(a: Skeleton, b: Skeleton, memo: dict) -> list[list[int]]:
    rows = [[0] * (len(b.children) + 1)]
    for x in a.children:
        last, row = rows[-1], [0]
        for j, y in enumerate(b.children):
            row.append(max(last[j + 1], row[j], last[j] + match(x, y, memo)))
        rows.append(row)
    return rows


class Template:
    """The union of a host's trees; the index of a node names a slot."""

    def __init__(self):
        self.root, self.size, self.known = Skeleton("", 0), 1, {}

    def place(self, tree: Skeleton) -> dict[int, int]:
        """Slots of a tree's nodes. Trees of one shape are aligned once."""
        shape = tree.text()
        if shape not in self.known:
            self.known[shape] = self._merge(self.root, tree, {}, [])
        order, slots = [], self.known[shape]
        todo = [tree]
        while todo:  # nodes in the order in which _merge numbers them
            x = todo.pop()
            order.append(x.index)
            todo.extend(reversed(x.children))
        return dict(zip(order, slots, strict=True))

    def _merge(self, t: Skeleton, x: Skeleton, memo: dict, out: list[int]) -> list[int]:
        out.append(t.index)
        rows = _table(t, x, memo)
        i, j, pairs = len(t.children), len(x.children), {}
        while i and j:
            w = match(t.children[i - 1], x.children[j - 1], memo)
            if w and rows[i][j] == rows[i - 1][j - 1] + w:
                i, j = i - 1, j - 1
                pairs[j] = t.children[i]
            elif rows[i][j] == rows[i - 1][j]:
                i -= 1
            else:
                j -= 1
        merged, at = [], 0
        for j, child in enumerate(x.children):
            if j in pairs:
                stop = t.children.index(pairs[j], at)
                merged += t.children[at : stop + 1]
                at = stop + 1
                self._merge(pairs[j], child, memo, out)
            else:
                new = Skeleton(child.label, self.size)
                self.size += 1
                merged.append(new)
                self._merge(new, child, {}, out)
        t.children = merged + t.children[at:]
        return out


def content(root: Skeleton, weight: Counter | dict[int, float]) -> set[int] | None:
    """Slots that structure leaves out; None: no container stands out. weight: characters of varying text by slot."""
    total: dict[int, float] = {}

    def add(node: Skeleton) -> float:
        total[node.index] = weight.get(node.index, 0) + sum(add(c) for c in node.children)
        return total[node.index]

    add(root)
    gone: set[int] = set()
    node, found = root, False
    while total[node.index] and not WHOLE.intersection(node.label.split(".")):
        boxes = [c for c in node.children if not c.textual]
        if not boxes:
            break
        top = max(boxes, key=lambda c: total[c.index])
        if total[top.index] < DOMINANT * total[node.index]:
            break
        if len(boxes) > 1:
            found = True
        todo = [c for c in boxes if c is not top and total[c.index] < SIDE * total[node.index]]
        while todo:
            x = todo.pop()
            gone.add(x.index)
            todo.extend(x.children)
        node = top
    return gone if found else None


def extract(sources: list[str], template: bool = True) -> list[str]:
    """Main texts of the pages of one host; blocks in page order, joined by a blank line.

    template False: by elements and names alone, without constants and structure.
    """
    wrapper, pages = Template(), []
    for source in sources:
        page = parse(source)
        slots = wrapper.place(page.tree)
        pages.append([(slots[i], text, linked, out, inside) for i, text, linked, out, inside in page.blocks])
    # copies of a page say nothing about what is constant, so pages with the same longest block count once
    seen, have, texts = set(), Counter(), Counter()
    chars, linked_chars, different = Counter(), Counter(), []
    for blocks in pages:
        longest = max((b[1] for b in blocks), key=len, default="")
        for slot, text, linked, *_ in blocks:
            chars[slot] += len(text)
            linked_chars[slot] += linked
        if longest in seen:
            continue
        seen.add(longest)
        different.append(blocks)
        have.update({b[0] for b in blocks})
        texts.update({(b[0], b[1]) for b in blocks})
    kinds = Counter(slot for slot, _ in texts)  # different texts of a slot

    def constant(slot: int, text: str, least: int) -> bool:
        n = texts[slot, text]
        return n >= least and n >= TEMPLATE_SHARE * have[slot]

    def varies(b) -> bool:
        # few pages tell constants only in slots that hold little else
        return not constant(b[0], b[1], 2 if kinds[b[0]] <= 2 else TEMPLATE_PAGES)

    def linky(slot: int) -> bool:
        return linked_chars[slot] > LINK_SHARE * chars[slot]

    def weigh(some) -> Counter:
        w: Counter = Counter()
        for blocks in some:
            for b in blocks:
                if not b[3] and not linky(b[0]) and varies(b):
                    w[b[0]] += len(b[1])
        return w

    gone = content(wrapper.root, weigh(different)) if template else None
    out = []
    for blocks in pages:
        named = [b for b in blocks if not b[3] and (b[4] or not linky(b[0]))]
        kept = named
        if template:
            kept = [b for b in named if gone is None or b[0] not in gone]
            if sum(len(b[1]) for b in kept if varies(b)) < 0.2 * sum(len(b[1]) for b in named if varies(b)):  # a page built unlike the host's others
                own = content(wrapper.root, weigh([blocks]))
                kept = [b for b in named if own is None or b[0] not in own]
        # structure is settled; an article or main element that holds much of what is left settles the rest
        inside = [b for b in kept if b[4]]
        if sum(len(b[1]) for b in inside) >= 0.3 * sum(len(b[1]) for b in kept) or gone is None and inside:
            kept = inside or kept
        if template:
            kept = [b for b in kept if varies(b)] or kept  # a page of constants only has no slot to tell them from
        out.append("\n\n".join(b[1] for b in kept))
    return out


def host_of(url: Column) -> Column:
    """Host of a url in lower case, without user, port and www; null or odd urls: empty."""
    found = F.regexp_extract(F.lower(F.coalesce(url.cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


def page_report(pages: DataFrame, group_pages: int = GROUP_PAGES, group_chars: int = GROUP_CHARS) -> DataFrame:
    """page_id, url, text, n_chars for every page, from its whole html.

    Null html is empty and gives an empty text; so does html without text. Pages without a host form a host of their own. Repeated
    rows stay, and pages with the same longest block count once in telling constants; very long pages are parsed whole, in
    time linear in their length; an empty table gives an empty result; further columns of any name play no part.
    """
    spark = pages.sparkSession
    small_batches(spark)
    slim = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    sizes, _ = materialize(slim.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("html")).alias("chars")).withColumn("groups", F.ceil(F.greatest(F.col("n") / group_pages, F.col("chars") / group_chars))), "hosts")
    large = sizes.filter("groups > 1").select("host", "groups")
    whole = sizes.agg(F.sum("chars").alias("c")).first()["c"] or 0
    tasks = max(partitions(spark), min(math.ceil(whole / TASK_CHARS), MANY_TASKS), math.ceil(whole / LARGE_TASK_CHARS))
    groups = F.broadcast(large) if large.limit(100_001).count() <= 100_000 else large
    dealt = slim.join(groups, "host", "left").withColumn("part", F.pmod(F.xxhash64("page_id", "url", F.xxhash64("html")), F.coalesce("groups", F.lit(1))))
    ordered = dealt.select("host", "part", "page_id", "url", "html").repartition(tasks, "host", "part").sortWithinPartitions("host", "part", "page_id", "url", "html")
    kinds = (slim.schema["page_id"].dataType, slim.schema["url"].dataType)
    schema = f"page_id {kinds[0].simpleString()}, url {kinds[1].simpleString()}, text string, n_chars long"

    def run(batches):
        key, held = None, []

        def done():
            whole = pa.Table.from_batches(held).combine_chunks()
            texts = extract(whole.column("html").to_pylist())
            return pa.RecordBatch.from_arrays([*(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (whole.column("page_id"), whole.column("url"))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

        for b in batches:
            hosts, parts = b.column(0).to_pylist(), b.column(1).to_pylist()
            start = 0
            for i in range(b.num_rows + 1):
                if i == b.num_rows or (hosts[i], parts[i]) != (hosts[start], parts[start]):
                    if i > start:
                        if held and key != (hosts[start], parts[start]):
                            yield done()
                            held = []
                        key = (hosts[start], parts[start])
                        held.append(b.slice(start, i - start))
                    start = i
        if held:
            yield done()

    return ordered.mapInArrow(lean(run), schema)
