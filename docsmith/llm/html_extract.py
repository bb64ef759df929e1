"""Main text of web pages by site template removal.

Every page is parsed into element subtrees.  A subtree's hash covers its tags and
its text, not its attributes.  Spark counts, per host, the different contents
beside which a subtree stands; a subtree found beside many contents of its host is
the site's template and is deleted from all their pages, before the article is
taken.  Elements that say what they are (navigation, footer, form, script, advert,
comment, ...) go on pages of small hosts too, where nothing can recur.  What is left
of the article (else the main element, else the body) is the text.

The content beside a subtree are the two largest text blocks outside of it, the
second only if it has ``BESIDE`` of the first's length; dates, menus and other chrome
do not count, so an article that is published under many addresses is one content and
no template.  A subtree that holds the page's largest block needs a block of ``BESIDE``
of its length outside; without one it is the page's own text and stays.

Running text (paragraphs, headings, lists, tables, quotes) is a template only beside
``TEXT_SHARE`` of the host's contents: a notice or a list of links on most articles
goes, a passage that some of them share stays.  The only article of a page is
never one; of several articles those that recur are.

Scale: a page sends only the hashes of its candidate subtrees to the counts,
which have partial sums on (host, subtree, content) and on (host, subtree);
a host with a third of all pages is spread over its subtrees.  A bounded filter of
hash buckets then leaves the subtrees that can be templates, and the pages meet
theirs by the hash of their html, in a join that AQE can split.

Edge cases: null html gives an empty text; pages without a host have no template
counts; unclosed, misnested and cut markup ends at the latest with its parent or
the page; very long pages are parsed in one pass; of equally large blocks the first
counts; repeated rows and null ids are kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.llm.common import content_key, python_workers, staged

#: A subtree is a template beside this many contents of its host, and beside this
#: share of them; on a large host beside ``min_pages`` times the binary logarithm of
#: their number, if that is less.  Running text needs ``TEXT_SHARE`` at any size.
MIN_PAGES, MIN_SHARE, TEXT_SHARE = 5, 0.01, 0.5
#: Part of a page's largest block that another must have to count as content.
BESIDE = 0.25
#: Upper bound of the broadcast filter.
BUCKETS = 1 << 18

# Element groups of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset "
               "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol "
               "p pre search section summary table ul".split())
BLOCKS = CLOSES_P | set("html body li dt dd tr td th thead tbody tfoot caption option legend "
                        "optgroup select button template video audio canvas svg".split())
SCOPES = set("html table td th caption button object template article section".split())
#: An opening tag ends these open elements, up to one of the second group.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

# What never belongs to an article.
DROP_TAGS = RAW | set("head nav footer aside form template svg math object embed canvas audio video "
                      "button select option dialog menu search".split())
DROP_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu "
                 "menubar toolbar form".split())
DROP_NAMES = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion "
                 "sidebar nav navbar navigation menu breadcrumb breadcrumbs footer header masthead "
                 "banner cookie cookies consent notice disclaimer popup modal newsletter subscribe "
                 "subscription share sharing social related recommended comment comments respond "
                 "disqus widget toolbar pagination pager skip paywall".split())
#: Blocks of running text.
TEXT_TAGS = HEADINGS | set("p li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th "
                           "caption figure figcaption hr address details summary".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKENS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attrs", "items", "hash", "text_hash")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs = tag, attrs
        self.items: list[Node | str] = []  # children and texts, in page order
        self.hash = 0

    def elements(self):
        return (x for x in self.items if isinstance(x, Node))


def _tag_end(html: str, at: int) -> int:
    """Index after the > that ends a tag; quoted values may hold one."""
    while True:
        stop = _STOP.search(html, at)
        if stop is None:
            return -1
        if stop[0] == ">":
            return stop.end()
        at = stop.end()
        if html[max(0, stop.start() - 80):stop.start()].rstrip().endswith("="):
            close = html.find(stop[0], at)
            if close >= 0:
                at = close + 1


def _open(stack: list[Node], tag: str, attrs: str) -> Node:
    if tag in CLOSES_P:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                del stack[i:]
                break
            if stack[i].tag in SCOPES:
                break
    if tag in SIBLINGS:
        ends, limits = SIBLINGS[tag]
        last = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in limits:
                break
            if stack[i].tag in ends:
                last = i
        if last is not None:
            del stack[last:]
    node = Node(tag, attrs)
    stack[-1].items.append(node)
    return node


def _close(stack: list[Node], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if tag not in BLOCKS and stack[i].tag in BLOCKS:
            return  # an inline end tag does not end a block
        if stack[i].tag in ("td", "th", "table") and tag not in (
                "table", "tr", "thead", "tbody", "tfoot", "body", "html", "article", "main"):
            return


def parse(html: str) -> Node:
    root = Node("#root")
    stack, at, size = [root], 0, len(html)
    while at < size:
        less = html.find("<", at)
        if less < 0:
            stack[-1].items.append(html[at:])
            break
        if less > at:
            stack[-1].items.append(html[at:less])
        if html.startswith("<!--", less):
            end = html.find("-->", less + 4)
            at = size if end < 0 else end + 3
            continue
        closing = html.startswith("</", less)
        name = _NAME.match(html, less + 1 + closing)
        if name is None:
            if closing or html.startswith(("<!", "<?"), less):
                end = html.find(">", less)
                at = size if end < 0 else end + 1
            else:
                stack[-1].items.append("<")
                at = less + 1
            continue
        end = _tag_end(html, name.end())
        if end < 0:
            break  # the page is cut inside a tag
        tag, attrs, at = name[0].lower(), html[name.end():end - 1], end
        if closing:
            _close(stack, tag)
            continue
        node = _open(stack, tag, attrs)
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
            stop = size if close is None else close.start()
            at = size if close is None else max(stop, html.find(">", stop) + 1 or size)
        elif tag not in VOID:
            stack.append(node)
    return root


def _attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(node.attrs)}


def _contains(node: Node, tags: set[str], skip: Node | None = None) -> bool:
    todo = [node]
    while todo:
        x = todo.pop()
        for child in x.elements():
            if child.tag in tags:
                return True
            todo.append(child)
    return False


def says_boilerplate(node: Node, in_article: bool) -> bool:
    """The element's own name, role, class, id or style excludes it."""
    if node.tag in DROP_TAGS:
        return True
    if node.tag == "header":
        return not (in_article and _contains(node, HEADINGS))
    if not node.attrs or node.attrs.isspace():
        return False
    attrs = _attributes(node)
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" \
            or _HIDDEN.search(attrs.get("style", "")):
        return True
    if attrs.get("role", "").lower() in DROP_ROLES:
        return True
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    if not names.isspace() and DROP_NAMES & set(_TOKENS.findall(_CAMEL.sub(" ", names).lower())):
        return node.tag not in ("html", "body", "article", "main") \
            and not _contains(node, {"article", "main", "h1"})
    return False


def _postorder(root: Node) -> list[Node]:
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo.extend(x.elements())
    order.reverse()
    return order


def hash_subtrees(root: Node) -> None:
    """The last bit of a hash tells running text."""
    for node in _postorder(root):
        h = xxhash.xxh64(node.tag.encode())
        for x in node.items:
            if isinstance(x, Node):
                h.update(b"\0" + x.hash.to_bytes(8, "little"))
            elif not x.isspace():
                h.update(b"\1" + " ".join(unescape(x).split()).encode("utf-8", "surrogatepass"))
        node.hash = h.intdigest() & ~1 | (node.tag in TEXT_TAGS)


def content_roots(root: Node) -> list[Node]:
    """The outermost articles, else main elements, else the page."""
    for wanted in ("article", "main"):
        found, todo = [], [root]
        while todo:
            x = todo.pop()
            if x.tag == wanted:
                found.append(x)
            elif x.tag not in DROP_TAGS:
                todo.extend(reversed(list(x.elements())))
        found = [x for x in found if not says_boilerplate(x, False)]
        if found:
            return found
    return [root]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def measured(root: Node, roots: list[Node]) -> tuple[list[str], list[tuple[Node, int, int]]]:
    """The text blocks of the article, in page order, and the subtrees that may be a
    template, each with the blocks from and up to which it holds.  What lies outside of
    the article or names itself boilerplate is no text anyway, and is neither."""
    inside = {id(x) for x in roots}
    holds: set[int] = set()  # the article and its ancestors
    for node in _postorder(root):
        if id(node) in inside or any(id(x) in holds for x in node.elements()):
            holds.add(id(node))
    texts: list[str] = []
    line: list[str] = []
    found = []

    def flush() -> None:
        text = " ".join(unescape("".join(line)).split())
        if text:
            texts.append(text)
        line.clear()

    # node or text, its first block if it closes, in the article, in running text
    todo: list[tuple] = [(root, None, False, False)]
    while todo:
        node, first, inner, running = todo.pop()
        if isinstance(node, str):
            if inner:
                line.append(node)
            continue
        if node.tag in BLOCKS or node is root:
            flush()
        if first is not None:
            if first >= 0:
                found.append((node, first, len(texts)))
            continue
        inner = inner or id(node) in inside
        if id(node) not in holds and (not inner or says_boilerplate(node, inner)):
            continue
        text = node.tag in TEXT_TAGS
        one_of_many = id(node) in inside and len(roots) > 1
        may = node.tag in BLOCKS and node.items and not (text and running) \
            and (id(node) not in holds or one_of_many)
        todo.append((node, len(texts) if may else -1, inner, running))
        todo.extend((x, None, inner, running or text) for x in reversed(node.items)
                    if isinstance(x, str) or not (x.tag in RAW or x.tag == "head"))
    return texts, found


def candidates(root: Node, roots: list[Node]) -> tuple[int, list[tuple[int, int]]]:
    """Hash of the page's content; hash of each subtree that may be a template with
    the hash of the content beside it."""
    texts, found = measured(root, roots)
    if not texts:
        return 0, []
    size = [len(x) for x in texts]

    def two(*places: int) -> tuple[int, ...]:
        return tuple(sorted(places, key=lambda i: (-size[i], i))[:2])

    before: list[tuple[int, ...]] = [()]  # the two largest blocks up to a place
    for i in range(len(size)):
        before.append(two(*before[-1], i))
    after: list[tuple[int, ...]] = [()]  # and from it on
    for i in reversed(range(len(size))):
        after.append(two(i, *after[-1]))
    after.reverse()
    largest = after[0][0]

    def content(first: int, last: int) -> int | None:
        outside = two(*before[first], *after[last])
        if not outside or (first <= largest < last and size[outside[0]] < size[largest] * BESIDE):
            return None
        key = xxhash.xxh64()
        for i in outside:
            if size[i] >= size[outside[0]] * BESIDE:
                key.update(texts[i].encode("utf-8", "surrogatepass") + b"\0")
        return _signed(key.intdigest())

    pairs = {(_signed(node.hash), beside) for node, first, last in found
             if (beside := content(first, last)) is not None}
    return content(0, 0), sorted(pairs)


def prune(root: Node, templates: set[int]) -> None:
    """Empty the subtrees that are templates."""
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag in BLOCKS and _signed(node.hash) in templates:
            node.items = []
        todo.extend(node.elements())


def blocks(root: Node) -> list[str]:
    """Text blocks in page order."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    roots = content_roots(root)
    for top in roots:
        has_article = top is not root
        # (node, True) opens, (node, False) closes
        todo: list[tuple[Node | str, bool]] = [(top, True)]
        while todo:
            item, opens = todo.pop()
            if isinstance(item, str):
                line.append(unescape(item))
                continue
            block = item.tag in BLOCKS
            if not opens:
                if block:
                    flush()
                continue
            if item is not top and says_boilerplate(item, has_article):
                if block:
                    flush()
                continue
            if block:
                flush()
            elif item.tag == "br":
                line.append(" ")
            todo.append((item, False))
            todo.extend((x, True) for x in reversed(item.items))
        flush()
    return out


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)),
                    F.lit(""))


def subtrees_of(htmls: pd.Series) -> pd.DataFrame:
    """Per page: hash of its content, hashes of its candidate subtrees and of the
    content beside each."""
    rows = []
    for html in htmls:
        root = parse(html)
        hash_subtrees(root)
        page, pairs = candidates(root, content_roots(root))
        rows.append((page, [s for s, _ in pairs], [b for _, b in pairs]))
    return pd.DataFrame(rows, columns=["page", "subtree", "beside"])


def text_of(htmls: pd.Series, templates: pd.Series) -> pd.DataFrame:
    """Per page: main text without the templates, number of templates."""
    rows = []
    for html, known in zip(htmls, templates):
        root = parse(html)
        if len(known):
            hash_subtrees(root)
            prune(root, set(known))
        rows.append(("\n".join(blocks(root)), len(known)))
    return pd.DataFrame(rows, columns=["text", "n_templates"])


def _bucket() -> Column:
    return F.pmod(F.xxhash64("host", "subtree"), F.lit(BUCKETS)).cast("int")


def page_templates(spark: SparkSession, pages: DataFrame, min_pages: int = MIN_PAGES,
                   min_share: float = MIN_SHARE, text_share: float = TEXT_SHARE) -> DataFrame:
    """(k1, k2, templates): the template subtrees of each page content that has any.
    ``pages`` has k1, k2, host and html."""
    subtrees = F.pandas_udf(subtrees_of, "page long, subtree array<long>, beside array<long>")
    parsed = pages.filter(F.col("host").isNotNull()) \
        .select("k1", "k2", "host", subtrees("html").alias("p")) \
        .select("k1", "k2", "host", "p.page", "p.subtree", "p.beside")
    hosted = staged(spark, parsed, "html-subtrees")
    per_host = staged(spark, hosted.select("host", "page").distinct().groupBy("host")
                      .agg(F.count("*").alias("host_pages")), "html-hosts")
    each = hosted.select("host", "k1", "k2", F.inline(F.arrays_zip("subtree", "beside")))
    counts = each.select("host", "subtree", "beside").distinct().groupBy("host", "subtree") \
        .agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    many = F.least(F.col("host_pages") * min_share, F.log2("host_pages") * min_pages)
    running = F.col("subtree").bitwiseAND(F.lit(1)) == 1
    templates = staged(spark, counts.join(per_host, "host").filter(
        F.col("n") >= F.when(running, F.col("host_pages") * text_share).otherwise(many))
        .select("host", "subtree"), "html-templates")
    near = each.select("host", "k1", "k2", "subtree").withColumn("b", _bucket()).join(
        F.broadcast(templates.select(_bucket().alias("b")).distinct()), "b", "left_semi").drop("b")
    on_page = near.distinct().join(templates, ["host", "subtree"])
    return staged(spark, on_page.groupBy("k1", "k2").agg(F.collect_list("subtree").alias("templates")),
                  "html-marks")


def extract(spark: SparkSession, pages: DataFrame, min_pages: int = MIN_PAGES,
            min_share: float = MIN_SHARE, text_share: float = TEXT_SHARE, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_templates."""
    python_workers(spark)
    html = F.coalesce(F.col(html_col), F.lit(""))
    keyed = pages.select(F.col(id_col), F.col(url_col), html.alias("html"),
                         host_of(F.col(url_col)).alias("host"))
    keyed = keyed.select("*", *content_key(F.col("host"), F.col("html")))
    marks = page_templates(spark, keyed, min_pages, min_share, text_share)
    joined = keyed.join(marks, ["k1", "k2"], "left")
    none = F.array().cast("array<long>")
    text = F.pandas_udf(text_of, "text string, n_templates long")
    found = joined.withColumn("found", text("html", F.coalesce("templates", none)))
    return found.select(id_col, url_col, F.col("found.text").alias("text"),
                        F.col("found.n_templates").alias("n_templates"))
