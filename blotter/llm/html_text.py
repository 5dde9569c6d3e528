"""HTML extraction by consensus host paths.

1. Every page's containers are scored by the text of their block children;
   from the best one the page climbs to the article or main around it and to
   parents that add nothing but block text (``_climb``). That container's
   generalised path (tag and class from the root, digits as #) is the page's
   vote.
2. Votes are summed per host and path in Spark, next to the weight of all pages
   that hold the path; every path keeps its sums. A vote weighs the number of
   binary digits of its score, so a page of little text counts less, but a few
   pages with very long listings do not outvote their host.
3. A page's own containers meet their paths' sums. A path's support is the
   share of the other pages holding it that vote for it; a page's own choice
   counts as supported by half at least, so another path of the page overrules
   it only with a larger support (ties: the page's own, then the larger text).
4. Every page is read again and gives the text of its winning path. A page
   that no path overruled has its own vote as winner, which the second reading
   finds again, so only overruled pages need a row of the join.

A path travels as a 16-byte hash of its steps (``_Node.key``). Time and memory
of a page grow in proportion to its length, however deep its elements stand.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out by element, role and class or id word. What such a
word (or an element like form) stands on is decided from the whole page: an
element that holds the page's main text (``_settle``) is its wrapper and stays,
parts like has-sidebar or article-header are layout words, and headings and
paragraphs go by fewer words (``TEXT_BOILERPLATE``). Character
references are decoded, white space inside a block becomes one space, blocks
are joined by ``\\n`` in page order.

Null or empty html gives the empty string; a null url votes as the host ``''``;
unclosed elements end with their parent or the page; a tag cut off at the end
of the page is dropped. Rows that share a page_id each give a row; a null
page_id passes through; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ship

# HTML element kinds.
SKIP = frozenset("script style noscript template iframe object select textarea head title".split())
SOFT = frozenset("nav footer aside form".split())  # left out unless they wrap the main text
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dt dd td th figcaption caption".split())
BOXES = frozenset("html body main article section div header ul ol dl table tbody thead tfoot tr figure details center "
                  "fieldset address nav aside footer form dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|side|sidebar\w*|menu\w*|nav\w*|breadcrumbs?|footer|header|"
    r"masthead|cookies?|notices?|consent|popup|modal|newsletter|subscri\w*|share|sharing|social|related|recommend\w*|"
    r"comments?|replies|reply|respond|disqus|login|signup|search|widgets?|copyright|disclaimer)(?:$|[\s_-])", re.I)
# Kinds whose text is often long and never the article: their size says nothing.
ASIDES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|promo\w*|sponsor\w*|cookies?|notices?|consent|popup|modal|newsletter|subscri\w*|related|"
    r"recommend\w*|comments?|replies|reply|respond|disqus|copyright|disclaimer)(?:$|[\s_-])", re.I)
# Words that leave out a heading, or a paragraph inside an article or main.
TEXT_BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|promo\w*|sponsor\w*|cookies?|consent|newsletter|subscri\w*|breadcrumbs?|related|"
    r"recommend\w*|comments?|replies|reply|disqus|copyright|widgets?|menu\w*|nav\w*|sidebar\w*)(?:$|[\s_-])", re.I)
LAYOUT = re.compile(
    r"(?:(?<=[\s_-])|^)(?:(?:has|with|without|no|not|hide|hides|show|shows)[_-][^\s_-]+"
    r"|(?:article|post|entry|story|content|page|section|title|main|news)[_-]header)(?=$|[\s_-])", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)"
                    r"|<(?=/?[a-zA-Z])[^>]*(>|\Z)", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_DIGITS = re.compile(r"\d+")


class _Node:
    """An element. Its path is not held as text, which would take depth times
    depth characters on a deep page, but as ``key``, a hash of the parent's key
    and the element's step."""
    __slots__ = ("tag", "parent", "step", "key", "skip", "own", "items", "order", "links", "words", "soft",
                 "inside", "box", "block")

    def __init__(self, tag, parent, step, skip, order):
        self.tag, self.parent, self.step, self.skip, self.order = tag, parent, step, skip, order
        self.key = b"" if parent is None else parent.key if not step else \
            blake2b(step.encode("utf-8", "replace"), key=parent.key, digest_size=16).digest()
        # in an article or main; nearest box and, below it, nearest block (the element itself counts)
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        self.box = order if parent is None or tag in BOXES else parent.box
        self.block = self if tag in BLOCKS else None if parent is None or tag in BOXES else parent.block
        self.own = 0
        self.links = 0
        self.words = ""
        self.soft = 0  # 1: left out unless it holds the main text, 2: the same, of a kind in ASIDES
        self.items: list = []  # text, or child nodes

    @property
    def path(self) -> str:
        """The generalised path as text."""
        steps, node = [], self
        while node is not None:
            if node.step:
                steps.append(node.step)
            node = node.parent
        return "".join("/" + x for x in reversed(steps))


def parse(page: str) -> list[_Node]:
    """The page's elements in page order; the first is the root. Skipped
    elements are kept as nodes whose text is not collected. ``held`` counts the
    open elements by name, those that are no boxes by the box they stand in, so
    a closing tag looks for its element only where there is one."""
    root = _Node("#root", None, "", False, 0)
    nodes, at, pos = [root], root, 0
    held: Counter = Counter()

    def spot(tag, box):
        return tag if tag in BOXES else (box, tag)

    def leave(node):
        """Close everything up to and with ``node``."""
        here = at
        while here is not node.parent:
            held[spot(here.tag, here.box)] -= 1
            here = here.parent
        return here

    for m in _TOKEN.finditer(page):
        if m.start() < pos:
            continue
        if m.start() > pos and not at.skip:
            at.items.append(page[pos:m.start()])
        pos = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            # a closing tag does not reach out of the box it stands in
            if held[spot(name, at.box)] > 0:
                node = at
                while node.tag != name:
                    node = node.parent
                at = leave(node)
            continue
        if name in VOID:
            if name in ("br", "hr") and not at.skip:
                at.items.append(" ")
            continue
        if name in BLOCKS or name in BOXES:  # implied ends: a block ends at the next block or box
            node, ends = at.block, None
            while node is not None:
                if node.tag == "p" or node.tag == name or (name in BLOCKS
                                                           and node.tag not in ("li", "td", "th", "dd", "blockquote")):
                    ends = node
                node = node.parent.block
            if ends is not None:
                at = leave(ends)
        attrs = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(m.group(3))} if m.group(3) else {}
        cls = " ".join(sorted(attrs.get("class", "").split()))
        step = name + ("." + _DIGITS.sub("#", cls.replace(" ", ".")) if cls else "")
        words = LAYOUT.sub("", f"{attrs.get('class', '')} {attrs.get('id', '')}").strip()
        inside = at.inside or at.tag in ("article", "main")
        skip = at.skip or name in SKIP
        soft = 0
        if name not in ("html", "body", "article", "main"):
            text = name in HEADINGS or (name in ("p", "pre", "blockquote") and inside)
            if words and (TEXT_BOILERPLATE if text else BOILERPLATE).search(words):
                soft = 2 if ASIDES.search(words) else 1
            elif name in SOFT or (name == "header" and not inside) or attrs.get("role", "") in (
                    "navigation", "banner", "contentinfo", "complementary", "search"):
                soft = 1
        inline = name not in BOXES and name not in BLOCKS
        child = _Node(name, at, "" if inline else step, skip, len(nodes))
        child.words, child.soft = words, soft
        nodes.append(child)
        if not skip:
            at.items.append(child)
        if name in RAW:  # no markup inside
            end = re.compile(rf"</{name}\s*>", re.I).search(page, pos)
            pos = end.end() if end else len(page)
            continue
        if not m.group(3).endswith("/"):
            at = child
            held[spot(name, child.box)] += 1
    if pos < len(page) and not at.skip:
        at.items.append(page[pos:])
    return _settle(nodes)


def _settle(nodes: list[_Node]) -> list[_Node]:
    """Decide the soft elements, outermost first, those of a kind in ASIDES
    last. While no article or main stands outside them, one stays if it holds
    it, or most of the page's text outside links and ASIDES; one of a kind in
    ASIDES only if nothing else is left, or if it holds it and most text."""
    if not any(n.soft for n in nodes):
        return nodes
    size, asides, articles, mains = ([0] * len(nodes) for _ in range(4))
    link = [False] * len(nodes)
    for n in nodes:
        link[n.order] = n.tag == "a" or (n.parent is not None and link[n.parent.order])
    for n in reversed(nodes):
        if n.skip:
            continue
        i = n.order
        if not link[i]:
            size[i] += sum(len(x.strip()) for x in n.items if isinstance(x, str))
        if n.parent is not None:
            up = n.parent.order
            size[up] += size[i]
            asides[up] += size[i] if n.soft == 2 else asides[i]
            # the outermost ones count; an article of a reader comment or teaser does not
            articles[up] += 1 if n.tag == "article" and not BOILERPLATE.search(n.words) else articles[i]
            mains[up] += n.tag == "main" or mains[i]
    total = size[0] - asides[0]
    # what stands outside every soft element
    outer = []
    covered = [False] * len(nodes)
    for n in nodes:
        covered[n.order] = n.parent is not None and (covered[n.parent.order] or n.parent.soft > 0)
        if n.soft and not covered[n.order] and not n.skip:
            outer.append(n)
    clean = size[0] - sum(size[n.order] for n in outer)
    clean_articles = articles[0] - sum(articles[n.order] for n in outer)
    clean_mains = mains[0] - sum(mains[n.order] for n in outer)
    below: dict[int, list[_Node]] = {}  # nearest soft elements inside each soft element
    near: list[int] = [-1] * len(nodes)
    for n in nodes:
        if n.parent is not None:
            near[n.order] = n.parent.order if n.parent.soft else near[n.parent.order]
            if n.soft and not n.skip and near[n.order] >= 0:
                below.setdefault(near[n.order], []).append(n)
    drop = [False] * len(nodes)
    queue = outer
    while queue:
        after: list[_Node] = []
        for n in sorted(queue, key=lambda x: (x.soft, -size[x.order], x.order)):
            i = n.order
            here = size[i]
            first = not clean_mains and (mains[i] > 0 or not clean_articles)  # no article or main stands outside
            holds = mains[i] > 0 or articles[i] > 0
            if n.soft == 2:
                stays = here > 0 and (first and holds and here > clean or clean == 0)
            else:
                stays = first and (mains[i] > 0 or articles[i] == 1 or holds and here > clean or (here - asides[i]) * 2 > total)
            if not stays:
                drop[i] = True
                continue
            inner = below.get(i, [])
            clean += here - sum(size[x.order] for x in inner)
            clean_articles += articles[i] - sum(articles[x.order] for x in inner)
            clean_mains += mains[i] - sum(mains[x.order] for x in inner)
            after += inner
        queue = after
    for n in nodes:
        n.skip = n.skip or drop[n.order] or (n.parent is not None and n.parent.skip)
        n.items = [x for x in n.items if isinstance(x, str) or not drop[x.order]]
    return nodes


def _blocks(node: _Node) -> list[str]:
    """Text blocks below ``node`` in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = " ".join(_html.unescape("".join(run)).split())
        run.clear()
        if text:
            out.append(text)

    stack = [(node, 0)]
    while stack:
        here, i = stack.pop()
        if i == 0 and (here.tag in BLOCKS or here.tag in BOXES):
            flush()
        while i < len(here.items):
            item = here.items[i]
            i += 1
            if isinstance(item, str):
                if here.tag != "header" or here.parent is None:
                    run.append(item)
            else:
                stack.append((here, i))
                stack.append((item, 0))
                break
        else:
            if here.tag in BLOCKS or here.tag in BOXES:
                flush()
    flush()
    return out


def best(nodes: list[_Node]) -> _Node:
    """The container with the most block text; nine tenths of a container's
    score count for its parent, so a split article meets in its parent."""
    for node in reversed(nodes):
        if node.skip:
            continue
        text = sum(len(x.strip()) for x in node.items if isinstance(x, str))
        if node.tag == "a":
            node.links += text
        if node.tag in BOXES or node.parent is None:
            node.own += text  # loose text
            if node.parent is not None:
                node.parent.own += node.own * 9 // 10
        elif node.parent is not None:
            total = node.own + text
            if node.tag in BLOCKS and node.links * 2 > total:  # a menu entry
                total = 0
            if node.tag in BLOCKS or node.parent.tag not in BOXES:
                node.parent.own += total
                node.parent.links += node.links if node.parent.tag not in BOXES else 0
            else:
                node.parent.own += total
        else:
            node.own += text
    boxes = [n for n in nodes if not n.skip and (n.tag in BOXES or n.parent is None)]
    return _climb(max(boxes, key=lambda n: (n.own, n.order)))


def _climb(node: _Node) -> _Node:
    """The article (or else main) around the container, then parents as long
    as all that they add is block text that is neither links nor boilerplate."""
    for tag in ("article", "main"):
        up = node
        while up is not None and up.tag != tag:
            up = up.parent
        if up is not None:
            node = up
            break
    at, up, waiting = node, node.parent, False
    while up is not None and up.tag not in ("html", "#root"):
        adds = _adds(up, at)
        if adds is None:
            break
        waiting = waiting or adds
        if waiting and (up.tag in BOXES):
            node, waiting = up, False
        at, up = up, up.parent
    return node


def _adds(up: _Node, at: _Node) -> bool | None:
    """Whether ``up`` adds block text around its child ``at``; None if it adds
    other things too: links, or in body boxes or texts that lack the title."""
    found = named = False
    for item in up.items:
        if item is at:
            continue
        if isinstance(item, str):
            if item.strip():
                if up.tag == "body":
                    return None
                found = True
            continue
        total, linked, title = _weigh(item)
        if not total:
            continue
        if linked * 2 > total or (up.tag == "body" and item.tag not in BLOCKS and not title):
            return None
        found = True
        named = named or title
    if found and up.tag == "body" and (not named or _weigh(at)[2]):
        return None
    return found


def _weigh(node: _Node) -> tuple[int, int, bool]:
    """(text, text in links, holds an h1) below ``node``."""
    total = linked = 0
    title = False
    stack = [(node, False)]
    while stack:
        here, link = stack.pop()
        link = link or here.tag == "a"
        title = title or here.tag == "h1"
        for x in here.items:
            if isinstance(x, str):
                n = len(x.strip())
                total += n
                linked += n if link else 0
            else:
                stack.append((x, link))
    return total, linked, title


def vote(page: str | None) -> tuple[str, int] | None:
    if not page:
        return None
    node = best(parse(page))
    return (node.path, node.own) if node.own > 0 else None


def candidates(page: str | None) -> list[tuple[bytes, int, bool, int]]:
    """(path's key, text size, is the page's vote, the vote's weight) of the page's containers."""
    if not page:
        return []
    nodes = parse(page)
    node = best(nodes)
    if node.own <= 0:
        return []
    sizes: dict[bytes, int] = {node.key: 0}
    for n in nodes:
        if not n.skip and n.own > 0 and (n.tag in BOXES or n is node):
            sizes[n.key] = sizes.get(n.key, 0) + n.own
    return [(key, size, key == node.key, node.own.bit_length()) for key, size in sizes.items()]


def extract(page: str | None, key: bytes | None) -> str:
    """Text of the page's containers with the path ``key``; its best container's
    where it has no text there or no key is given. Containers of one path never
    stand in one another: a nested one has a longer path."""
    if not page:
        return ""
    nodes = parse(page)
    if key is not None:
        text = "\n".join(b for n in nodes if n.key == key and not n.skip and n.tag in BOXES for b in _blocks(n))
        if text:
            return text
    return "\n".join(_blocks(best(nodes)))


_CANDIDATES = pa.schema([("host", pa.string()), ("key", pa.binary()), ("path", pa.binary()), ("size", pa.int64()),
                         ("own", pa.bool_()), ("weight", pa.int64())])


def _candidates(batches):
    for b in batches:
        rows = [(h, k, *c) for h, k, p in zip(*(b.column(i).to_pylist() for i in range(3))) for c in candidates(p)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_CANDIDATES)], schema=_CANDIDATES)


def _texts(batches):
    for b in batches:
        paths, pages = b.column("path").to_pylist(), b.column("html").to_pylist()
        text = pa.array([extract(p, w) for p, w in zip(pages, paths)], pa.string())
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), b.column("host"), text],
                                         ["page_id", "url", "host", "text"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, text) for every row of ``pages``. Only pages whose
    own choice is overruled need a row in the last join; a page is known by the
    hash of its host and html. Every join has tables or plain shuffles on both
    sides, so it can be split on a hot host, path or page."""
    ship(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    base = pages.select("page_id", "url", "html", host.alias("host"))
    key = F.unhex(F.md5(F.concat("host", F.lit("\n"), "html")))
    found = cut(base.select("host", key.alias("key"), "html").mapInArrow(
        _candidates, "host string, key binary, path binary, size long, own boolean, weight long"), "containers")
    sums = cut(found.groupBy("host", "path").agg(F.sum(F.when(F.col("own"), F.col("weight")).otherwise(0)).alias("votes"),
                                                 F.sum("weight").alias("holders")).where("votes > 0"), "votes")
    mine = F.when(F.col("own"), F.col("weight")).otherwise(0)
    support = F.coalesce(F.try_divide(F.col("votes") - mine, F.col("holders") - F.col("weight")), F.lit(0.0))
    rated = found.join(sums, ["host", "path"]).withColumn(
        "support", F.when(F.col("own"), F.greatest(support, F.lit(0.5))).otherwise(support)).where("own or support > 0.5")
    overruled = rated.groupBy("key").agg(F.max(F.struct("support", "own", "size", "path")).alias("w")) \
        .where("not w.own").select("key", F.col("w.path").alias("path"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return base.withColumn("key", key).join(cut(overruled, "overruled"), "key", "left") \
        .select("page_id", "url", "html", "host", "path") \
        .mapInArrow(_texts, f"page_id {kind}, url string, host string, text string")
