"""Main text of pages by wrapper induction (operator 3).

Each host has a wrapper: the DOM trees of several of its pages, aligned one after the other by simple tree matching and
merged into one tree, whose nodes may be optional or repeated. Every page is aligned with its host's wrapper, so that its
nodes get the wrapper's slots. What stands in a slot is counted over the host's distinct pages: slots that hold the same
texts on most of them are template, varying ones are content. Tags and class names only decide what counts can't: pages
of hosts with too few pages, and varying parts such as adverts and reader comments.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
import zlib
from collections import Counter, OrderedDict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textflat as tf
from .base import few_bytes, read, text_of, written

#: Pages of a host that are merged to its wrapper.
SAMPLES = 5
#: Distinct pages of a host that must have one text in a slot for it to be frequent there, and their share of those with the slot.
MIN_PAGES, SHARE = 3, 0.6
#: The same inside an article or main element, and in nodes that the wrapper lacks, where equal texts are rather near copies of an article than template.
ARTICLE_PAGES, ARTICLE_SHARE = 5, 0.9
#: Share of frequent texts among all of a slot that makes it template, and pages from which a text on ARTICLE_SHARE of all is template anywhere.
CONSTANT, ANYWHERE_PAGES = 0.5, 20
#: Share of the text around it that marked articles or main elements must have to be the page's text.
PART = 0.3
#: Share of a host's varying text below which the wrapper's node that holds it isn't narrowed down further.
MASS = 0.8
#: Siblings of one tag, class and kinds of children that are a repeated node, and siblings of one tag that are one whatever their classes.
REPEATED, LISTED = 3, 32

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object textarea title".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that are never part of the main text.
CHROME = frozenset("head nav footer aside form script style noscript template svg math iframe object button select textarea input dialog menu title".split())
#: Words in class, id or role of parts that vary from page to page and yet are no article: adverts, navigation, reader comments.
APART_WORD = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|adsby\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|footer\w*|masthead|topbar|toolbar|"
    r"cookie\w*|consent|gdpr|popup|modal|overlay|comments?|commentlist|disqus|respond|repl(?:y|ies)|login|signup|subscribe\w*|newsletter|"
    r"pagination|pager|navigation|contentinfo|complementary|skip|copyright|hidden)(?:$|[\s_-])",
    re.I,
)
#: Words that an article's own parts may have as well; a slot that varies inside an article is none of these.
DOUBTFUL_WORD = re.compile(r"(?:^|[\s_-])(?:side|widget\w*|notice\w*|alert|form|search\w*|share\w*|sharing|social|related|recommend\w*|tags?|legal)(?:$|[\s_-])", re.I)
#: The same, unless it stands in an article or main element.
HEADER_WORD = re.compile(r"(?:^|[\s_-])(?:header|heading|banner|title-?bar)(?:$|[\s_-])", re.I)
TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)|([^<]+|<)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-hidden|hidden|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|/|$)", re.I)
CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Tags that end an open element of the named ones when they begin.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


#: What an element's tag and attributes say: nothing, that it holds the main text or an article, that it is a header, perhaps or surely no part of the main text.
PLAIN, MAIN, ARTICLE, HEADER, DOUBTFUL, APART = range(6)


class Node:
    """An element (tag, class, children) or a text (tag "", text)."""

    __slots__ = ("tag", "mark", "kids", "text", "style", "slot")

    def __init__(self, tag: str, mark: int = PLAIN, text: str = "", style: str = ""):
        self.tag, self.mark, self.text, self.style = tag, mark, text, style
        self.kids: list[Node] = []
        self.slot = -1


def mark_of(tag: str, attributes: str) -> int:
    if tag in CHROME:
        return APART
    out = {"article": ARTICLE, "main": MAIN, "header": HEADER}.get(tag, PLAIN)
    if not attributes:
        return out
    if HIDDEN.search(attributes):
        return APART
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = a or b or c
        name = name.lower()
        if name in ("class", "id", "role"):
            if tag == "article" and re.search(r"\bcomment", value, re.I):
                return APART
            if tag not in ("html", "body", "article", "main", "h1"):
                if APART_WORD.search(value):
                    return APART
                if DOUBTFUL_WORD.search(value):
                    out = DOUBTFUL
            if name == "role" and value.lower() in ("main", "article"):
                out = max(out, MAIN if value.lower() == "main" else ARTICLE)
            elif out == PLAIN and tag not in ("html", "body", "h1") and HEADER_WORD.search(value):
                out = HEADER
        elif name == "itemprop":
            if value.lower() == "articlebody":
                out = max(out, MAIN)
        elif name == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                return APART
        elif value.lower() != "false":
            return APART
    return out


def parse(source: str) -> Node:
    """A tree for any input: unknown end tags are ignored, open elements end with their parents."""
    root = Node("#")
    stack = [root]
    at, n = 0, len(source)
    while at < n:
        m = TOKEN.match(source, at)
        if m is None:  # a bare <
            at += 1
            continue
        at = m.end()
        end, tag, attributes, text = m.group(1, 2, 3, 4)
        if text is not None:
            if text.strip():
                stack[-1].kids.append(Node("", text=text))
            elif stack[-1].kids:
                stack[-1].kids.append(Node(" "))
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if end:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES[tag]:
                    del stack[i:]
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "select", "div"):
                    break
        style = CLASS.search(attributes)
        node = Node(tag, mark_of(tag, attributes), style=(style[1] or style[2] or style[3] or "") if style else "")
        stack[-1].kids.append(node)
        if tag in RAW and not attributes.rstrip().endswith("/"):
            stop = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(source, at)
            at = stop.end() if stop else n
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append(node)
    return root


class Part:
    """A node of a page's outline or of a wrapper: an element, or all those siblings that repeat. shape: its tags, equal for equal trees."""

    __slots__ = ("tag", "repeated", "kids", "members", "shape", "size", "slot")

    def __init__(self, tag: str, repeated: bool = False, members: list[Node] | None = None):
        self.tag, self.repeated, self.members = tag, repeated, members or []
        self.kids: list[Part] = []
        self.shape, self.size, self.slot = "", 1, -1


def outline(page: Node) -> Part:
    """The page's elements with siblings that repeat taken as one node; so a node has few children however long the page is."""
    root = Part(page.tag, members=[page])
    todo = [root]
    while todo:
        x = todo.pop()
        elements = [k for m in x.members for k in m.kids if k.tag.strip()]
        kind = {id(k): (k.tag, k.style, frozenset(c.tag for c in k.kids if c.tag in BLOCK)) for k in elements}
        kinds, tags = Counter(kind.values()), Counter(k.tag for k in elements)
        lists: dict = {}
        for k in elements:
            if x.repeated or tags[k.tag] > LISTED:
                key = k.tag
            elif kinds[kind[id(k)]] >= REPEATED:
                key = kind[id(k)]
            else:
                key = id(k)
            if key in lists:
                lists[key].members.append(k)
            else:
                lists[key] = Part(k.tag, key != id(k), [k])
                x.kids.append(lists[key])
        todo.extend(x.kids)
    return finish(root)


def finish(root: Part) -> Part:
    """Shapes and sizes from below, without recursion."""
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo.extend(x.kids)
    for x in reversed(order):
        x.size = 1 + sum(k.size for k in x.kids)
        x.shape = f"{x.tag}({''.join(k.shape for k in x.kids)})" if x.size < 64 else f"{x.tag}#{hash(tuple(k.shape for k in x.kids))}"
    return root


def match(a: Part, b: Part, memo: dict) -> int:
    """Simple tree matching: most node pairs of an order-preserving mapping of equal tags (Yang 1991)."""
    todo = [(a, b)]
    while todo:
        x, y = todo[-1]
        key = (x.shape, y.shape)
        if key in memo or x.tag != y.tag or x.shape == y.shape:
            todo.pop()
            continue
        open_ = [(i, j) for i in x.kids for j in y.kids if i.tag == j.tag and i.shape != j.shape and (i.shape, j.shape) not in memo]
        if open_:
            todo.extend(open_)
            continue
        row = [0] * (len(y.kids) + 1)
        for i in x.kids:
            last = 0
            for n, j in enumerate(y.kids, 1):
                here = row[n]
                row[n] = max(here, row[n - 1], last + known(i, j, memo))
                last = here
        memo[key] = 1 + row[-1]
        todo.pop()
    return known(a, b, memo)


def known(a: Part, b: Part, memo: dict) -> int:
    return 0 if a.tag != b.tag else a.size if a.shape == b.shape else memo[a.shape, b.shape]


def pairs(a: Part, b: Part, memo: dict) -> list[tuple[int, int]]:
    """The children that a best matching of two nodes maps to each other, from the last ones on."""
    match(a, b, memo)
    if a.shape == b.shape:
        return [(i, i) for i in reversed(range(len(a.kids)))]
    m, n = len(a.kids), len(b.kids)
    w = [[match(x, y, memo) for y in b.kids] for x in a.kids]
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w[i - 1][j - 1])
    i, j, out = m, n, []
    while i and j:
        if w[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + w[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return out


def merge(wrapper: Part, page: Part) -> Part:
    """Adds the page's nodes that the wrapper lacks, behind the neighbours that it has; they are optional there."""
    memo: dict = {}
    todo = [(wrapper, page)]
    while todo:
        a, b = todo.pop()
        a.repeated |= b.repeated
        both = pairs(a, b, memo)
        todo.extend((a.kids[i], b.kids[j]) for i, j in both)
        place, mapped = len(a.kids), dict((j, i) for i, j in both)
        for j in reversed(range(len(b.kids))):
            if j in mapped:
                place = mapped[j]
            else:
                before = next((mapped[k] for k in range(j - 1, -1, -1) if k in mapped), -1)
                a.kids.insert(min(place, before + 1), b.kids[j])
    return finish(wrapper)


def written_tree(root: Part) -> str:
    """A wrapper as text: each node's depth, tag and whether it is repeated, in page order."""
    out, todo = [], [(root, 0)]
    while todo:
        x, depth = todo.pop()
        out.append(f"{depth} {x.tag}{' *' * x.repeated}")
        todo.extend((k, depth + 1) for k in reversed(x.kids))
    return "\n".join(out)


def read_tree(text: str) -> Part:
    """A wrapper from its text; slots are its nodes in page order."""
    path: list[Part] = []
    for slot, line in enumerate(text.split("\n")):
        depth, tag, *repeated = line.split(" ")
        x = Part(tag, bool(repeated))
        x.slot = slot
        del path[int(depth) :]
        if path:
            path[-1].kids.append(x)
        path.append(x)
    return finish(path[0])


def content_slots(wrapper: Part, mass: dict[int, int]) -> range:
    """Slots of the innermost container that holds nearly all of the host's varying text; nothing is split off a heading."""
    upto = [0]
    for slot in range(wrapper.size):
        upto.append(upto[-1] + mass.get(slot, 0))
    of = lambda x: upto[x.slot + x.size] - upto[x.slot]
    x = wrapper
    while not any(k.tag in HEADINGS for k in x.kids):
        inner = max(x.kids, key=of, default=None)
        if inner is None or inner.repeated or of(inner) < MASS * upto[-1] or not any(k.tag in BLOCK for k in inner.kids):
            break
        x = inner
    return range(x.slot, x.slot + x.size)


HEADINGS = ("h1", "h2", "h3")


def align(wrapper: Part, page: Part, memo: dict) -> None:
    """Gives the page's elements the slots of the wrapper's nodes that simple tree matching maps to them."""
    todo = [(wrapper, page)]
    while todo:
        a, b = todo.pop()
        b.slot = a.slot
        for x in b.members:
            x.slot = a.slot
        todo.extend((a.kids[i], b.kids[j]) for i, j in pairs(a, b, memo))


#: A block of text: slot of the element where it begins (its place if the wrapper lacks it), level (2 in an article, 1 in a main element, else 0), doubtful by its marks, text, slot of the nearest element around that has one.
Block = tuple[int, int, bool, str, int]


def place(around: int, x: Node) -> int:
    """The slot of an element that the wrapper lacks, below -1: it tells the tags and classes on the way from the nearest element that has one."""
    return -2 - (zlib.crc32(f"{around} {x.tag} {x.style}".encode("utf-8", "surrogatepass")) >> 1)


def blocks(page: Node) -> list[Block]:
    """Blocks of text in page order, without what is apart by its marks. A block ends where a block element begins or ends; br is white space."""
    out: list[Block] = []
    parts: list[str] = []
    first, near = (-1, 0, False), -1

    def flush() -> None:
        text = " ".join(html_lib.unescape("".join(parts)).split())
        if text:
            out.append((*first, text, near))
        parts.clear()

    todo: list[tuple[Node, int, bool, tuple[int, int], bool]] = [(page, 0, False, (-1, -1), False)]
    blank = True
    while todo:
        x, level, doubtful, slots, leaving = todo.pop()
        if leaving:
            flush()
            blank = True
            continue
        if x.tag == "":
            if blank:
                first, near, blank = (slots[0], level, doubtful), slots[1], False
            parts.append(x.text)
            continue
        if x.tag in (" ", "br"):
            parts.append(" ")
            continue
        if x.tag in BLOCK:
            flush()
            blank = True
        if x.mark == APART:
            continue
        doubtful = doubtful or x.mark == DOUBTFUL or x.mark == HEADER and not level
        level = max(level, {MAIN: 1, ARTICLE: 2}.get(x.mark, 0))
        if x.tag in BLOCK:
            todo.append((x, level, doubtful, slots, True))
        if x.slot >= 0:
            inner = (x.slot, x.slot)
        else:
            inner = (place(slots[0], x), slots[1]) if slots[1] >= 0 else (-1, -1)
        todo.extend((k, level, doubtful, inner, False) for k in reversed(x.kids))
    flush()
    return out


def main_part(found: list[Block], content: range = range(0)) -> list[Block]:
    """The blocks in the host's content slots if they are a good part of the page's text; of them the blocks in articles if they are a good part of the main elements' text, else those in main elements if they are one of all, else all."""
    held = [x for x in found if x[4] in content]
    if held and sum(len(x[3]) for x in held) >= PART * sum(len(x[3]) for x in found):
        found = held
    for level in (2, 1):
        inside, around = ([x for x in found if x[1] >= l] for l in (level, level - 1))
        if inside and sum(len(x[3]) for x in inside) >= PART * sum(len(x[3]) for x in around):
            return inside
    return found


class Wrappers:
    """The wrappers that a task met last, read."""

    def __init__(self, most: int = 200):
        self.held: OrderedDict[str, tuple[Part, range, dict]] = OrderedDict()
        self.most = most

    def blocks(self, host: str, wrapper: str | None, page: Node, mass: list[dict] | None = None) -> tuple[list[Block], range]:
        """The page's blocks with their slots in the host's wrapper, and the host's content slots."""
        if wrapper is None:
            return blocks(page), range(0)
        if host not in self.held:
            tree = read_tree(wrapper)
            self.held[host] = (tree, content_slots(tree, {x["slot"]: x["chars"] for x in mass or ()}), {})
            if len(self.held) > self.most:
                self.held.popitem(last=False)
        tree, content, memo = self.held[host]
        if len(memo) > 200_000:
            memo.clear()
        align(tree, outline(page), memo)
        return blocks(page), content


def induced(pdf: pd.DataFrame) -> pd.DataFrame:
    """The wrapper of one host from its sampled pages (SAMPLES at most)."""
    trees = [outline(parse(x)) for x in pdf.sort_values(["key", "html"])["html"]]
    wrapper = trees[0]
    for x in trees[1:]:
        wrapper = merge(wrapper, x)
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [written_tree(wrapper)]})


def slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, wrapper, html) to the digest of the page's main part and what stands in its slots: slot, hash of the text (0: any), whether it lies in the main part, times, characters that aren't doubtful."""
    wrappers = Wrappers()
    fields = [("slot", pa.int32()), ("hash", pa.int64()), ("level", pa.int32()), ("times", pa.int32()), ("chars", pa.int64())]
    kind, names = pa.list_(pa.struct(fields)), [f[0] for f in fields]
    for batch in batches:
        for c in tf.chunks(batch, "html"):
            rows: dict[tuple[str, bytes], list] = {}
            for host, wrapper, source in zip(*(c.column(k).to_pylist() for k in ("host", "wrapper", "html")), strict=True):
                found, _ = wrappers.blocks(host, wrapper, parse(source))
                if found:
                    key = (host, digest("\n".join(x[3] for x in main_part([x for x in found if not x[2]] or found)), 16))
                    counts: dict[tuple, list[int]] = {}
                    for slot, level, doubtful, text, _ in found:
                        if slot != -1:
                            for h in (hash_text(slot, text), 0):
                                x = counts.setdefault((slot, h, int(level > 0)), [0, 0])
                                x[0] += 1
                                x[1] += 0 if doubtful else len(text)
                    here = sorted((*k, *x) for k, x in counts.items())
                    rows[key] = min(rows.get(key, here), here)
            lists = [[dict(zip(names, x, strict=True)) for x in r] for r in rows.values()]
            yield pa.record_batch([pa.array([k[0] for k in rows], pa.string()), pa.array([k[1] for k in rows], pa.binary()), pa.array(lists, kind)], ["host", "main", "slots"])


def digest(text: str, size: int) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=size).digest()


def hash_text(slot: int, text: str) -> int:
    """Tells a text in a slot from other texts and slots; not 0."""
    return int.from_bytes(digest(f"{slot} {text}", 8), "little", signed=True) or 1


def main_text(found: list[Block], content: range, template: set[int], varying: set[int]) -> str:
    """Blocks that are neither template nor, unless their slot is known to vary inside an article, doubtful."""
    left = [x for x in found if hash_text(x[0], x[3]) not in template and not (x[2] and not (x[1] and x[0] in varying))]
    return "\n".join(x[3] for x in main_part(left, content))


def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, host, wrapper, template, varying, mass, html) to the main texts."""
    wrappers = Wrappers()
    for batch in batches:
        for c in tf.chunks(batch, "html"):
            texts = []
            for host, wrapper, template, varying, mass, source in zip(*(c.column(k).to_pylist() for k in ("host", "wrapper", "template", "varying", "mass", "html")), strict=True):
                texts.append(main_text(*wrappers.blocks(host, wrapper, parse(source), mass), set(template or ()), set(varying or ())))
            yield pa.record_batch([c.column("page_id"), c.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def wrappers_of(own: DataFrame) -> DataFrame:
    """(host, wrapper) of all hosts with MIN_PAGES different pages or more; own: host, html, key (hash of the html)."""
    sampled = [F.min_by("key", F.xxhash64("key", F.lit(i))).alias(f"k{i}") for i in range(SAMPLES)]
    hosts = own.where("html <> ''").groupBy("host").agg(F.approx_count_distinct("key").alias("pages"), *sampled).where(F.col("pages") >= MIN_PAGES)
    chosen = written(hosts.select("host", F.explode(F.array_distinct(F.array(*[f"k{i}" for i in range(SAMPLES)]))).alias("key")), "wrapper-pages")
    chosen = few_bytes(chosen, F.octet_length("host"))
    trees = own.join(chosen, ["host", "key"]).dropDuplicates(["host", "key"]).select("host", "key", "html")
    return written(trees.groupBy("host").applyInPandas(induced, "host string, wrapper string"), "wrappers")


def template_of(own: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, template: hashes of texts in their slots, varying: slots that vary inside articles, mass: characters of varying text by slot) by counts over the host's distinct pages."""
    size = F.octet_length("wrapper") + F.octet_length("host")
    found = own.select("host", "html").join(few_bytes(wrappers, size), "host").select("host", "wrapper", "html")
    found = found.mapInArrow(slot_rows, "host string, main binary, slots array<struct<slot:int,hash:long,level:int,times:int,chars:long>>")
    distinct = written(found.groupBy("host", "main").agg(F.min("slots").alias("slots")), "distinct-pages")
    pages = written(distinct.groupBy("host").agg(F.count("*").alias("pages")), "host-pages")
    texts = distinct.select("host", F.explode("slots").alias("x")).groupBy("host", "x.slot", "x.level", "x.hash").agg(F.count("*").alias("n"), F.sum("x.times").alias("times"), F.sum("x.chars").alias("chars"))
    texts = written(texts, "slot-texts")
    slots = texts.where("hash = 0").select("host", "slot", "level", F.col("n").alias("all"), F.col("times").alias("all_times"), F.col("chars").alias("all_chars"))
    per = few_bytes(written(slots.join(few_bytes(pages, F.octet_length("host")), "host"), "slots"), F.octet_length("host") + 24)
    both = texts.where(F.col("hash") != 0).join(per, ["host", "slot", "level"])
    inside = (F.col("level") > 0) | (F.col("slot") < 0)
    frequent = (F.col("n") >= F.when(inside, ARTICLE_PAGES).otherwise(MIN_PAGES)) & (F.col("n") >= F.when(inside, ARTICLE_SHARE).otherwise(SHARE) * F.col("all"))
    both = both.where(F.col("n") >= MIN_PAGES).withColumn("frequent", frequent)
    anywhere = (F.col("n") >= ANYWHERE_PAGES) & (F.col("n") >= ARTICLE_SHARE * F.col("pages"))
    by_slot = both.groupBy("host", "slot", "level", "all", "all_times").agg(F.sum(F.when(F.col("frequent"), F.col("times")).otherwise(0)).alias("same"), F.sum(F.when(F.col("frequent"), F.col("chars")).otherwise(0)).alias("same_chars"), F.collect_set(F.when(F.col("frequent"), F.col("hash"))).alias("of_slot"), F.collect_set(F.when(anywhere, F.col("hash"))).alias("of_host"))
    constant = F.col("same") >= CONSTANT * F.col("all_times")
    texts_of = by_slot.groupBy("host").agg(F.flatten(F.collect_list(F.when(constant, F.concat("of_slot", "of_host")).otherwise(F.col("of_host")))).alias("template"))
    fixed = by_slot.where(constant).select("host", "slot", "level")
    varying = per.where((F.col("level") > 0) & (F.col("slot") >= 0) & (F.col("all") >= MIN_PAGES)).join(fixed, ["host", "slot", "level"], "left_anti").groupBy("host").agg(F.collect_set("slot").alias("varying"))
    mass = per.where("slot >= 0").join(by_slot.where(constant).select("host", "slot", "level", "same_chars"), ["host", "slot", "level"], "left")
    mass = mass.groupBy("host", "slot").agg(F.sum(F.col("all_chars") - F.coalesce("same_chars", F.lit(0))).alias("chars")).groupBy("host").agg(F.collect_list(F.struct("slot", "chars")).alias("mass"))
    return pages.select("host").join(mass, "host", "left").join(texts_of, "host", "left").join(varying, "host", "left")


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars (code points).

    On hosts with MIN_PAGES different pages or more, texts that stand in the same slot of the host's wrapper on most pages
    are dropped where such texts make up half of the slot or more: it is template; all other slots are content. Inside
    articles more and nearly all pages must agree (ARTICLE_PAGES, ARTICLE_SHARE). Never given are scripts, styles, forms,
    nav, footer, aside elements, hidden parts, and parts whose class, id or role says advert, menu, comment and the like;
    other doubtful marks count unless the slot is known to vary inside an article. Of what is left, the text is what stands
    in the wrapper's innermost node with nearly all of the host's varying text (MASS), if it is a good part of the page's
    (PART); then articles, else main elements, if they are a good part of that. White space in a block becomes one space; blocks are joined by a
    line feed. Null or empty html and pages without text give an empty text. A null url, or one without a host, belongs
    to the host "". Rows that repeat an id are pages of their own; equal pages get equal texts. Ties between pages for the
    wrapper go by their hashes, between equal matchings to the later nodes. Pages of any length are read as a whole.
    Empty table: no rows. Columns besides these three are not read.

    Nodes of layouts that none of the merged pages has get slots by their tags and classes below the nearest node that the
    wrapper has; these are counted over all pages like the others, so a rare layout's template goes too, from ARTICLE_PAGES
    pages on.

    Slots are counted over all of a host's pages, those with one main part as one page: copies of a page say nothing of its
    template. Pages go to the shuffle as hashes by host and main part, so a host may hold any share of the pages.
    """
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), text_of(html).alias("html"))
    keyed = own.select("host", "html", F.xxhash64("html").alias("key"))
    wrappers = wrappers_of(keyed)
    hosts = written(wrappers.join(template_of(keyed, wrappers), "host", "left").select("host", "wrapper", "template", "varying", "mass"), "wrappers")
    size = F.octet_length("wrapper") + F.octet_length("host") + F.lit(8) * F.greatest(F.size("template"), F.lit(0)) + F.lit(4) * F.greatest(F.size("varying"), F.lit(0)) + F.lit(16) * F.greatest(F.size("mass"), F.lit(0))
    full = own.join(few_bytes(hosts, size), "host", "left").select("page_id", "url", "host", "wrapper", "template", "varying", "mass", "html")
    kind = pages.schema[page_id].dataType.simpleString()
    out = full.mapInArrow(text_rows, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))
