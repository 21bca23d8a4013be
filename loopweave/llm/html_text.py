"""Main text of web pages with a site style tree: pages of a host laid over each other show what the site repeats.

A page becomes a list of blocks, each with its path of elements. Two kinds of branches are told apart:

* never content, by what HTML says they are: navigation, headers and footers of the page, sidebars, forms, scripts,
  styles, hidden parts, and elements whose class, id or role names an advert, a notice, a menu, comments and the like;
  A name, or a form, doesn't drop a branch that holds the page's articles or most of its text, such as a wrapper named
  after a sidebar beside it; what lies in it is judged like the rest;
* all other branches, those of articles too, which the style tree judges. Its nodes are the elements with text, by host and
  path, inner ones with all that lies below them; the text of an element itself is a leaf. Headings and paragraphs without a
  name of their own inside an article are part of its running text, so the leaf of the element around them holds them.
  For every node the tree counts on how many different pages it stands, and in which presentations (sequences of child
  elements) and contents (texts), each of the whole page at that path; a page with many cells counts once there, and so
  do pages of one and the same text. The importance of a node is the mean of the two entropies, each divided by the
  logarithm of the number of pages: 0 if all pages look and read the same there, 1 if all differ. Branches below
  ``least`` on hosts with at least ``pages`` pages of that node go, with all that lies in them.

What the tree finds important doesn't bring back a branch of the first kind, as comments and adverts differ from page to page.
It doesn't take most of an article's text either: pages may tell one story with other dates beside it.

If a page has an article or a main element, only what lies inside is considered; otherwise the whole body is. Of a page's
nodes only hashes are counted, map-side combined and joined back by (host, path) as a written table, so a host with a third
of all pages is an ordinary hot partition of a join; texts are joined only if some branch goes.

Defined cases: null html counts as empty and has the empty text; a null url is a host of its own; markup that ends
early or is not closed is read as far as it goes; repeated rows are extracted each; an empty table gives an empty
result; pages of any length are read whole. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import settle

#: Elements and names by their meaning in HTML.
SKIPPED = {"nav", "footer", "aside", "form", "noscript", "template", "iframe", "svg", "button", "select", "head", "dialog", "menu", "object", "canvas", "audio", "video"}
RAW = "script|style|textarea|title|noscript|template|iframe"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTENT = {"p", "pre", "blockquote", *HEADINGS}
ARTICLE = {"article", "main"}
NOISE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "newsletter", "subscribe", "subscription", "popup", "modal", "overlay",
    "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead", "toolbar",
    "comment", "comments", "disqus", "replies", "share", "sharing", "social", "related", "recommended", "widget", "login",
    "contentinfo", "complementary", "search", "pagination", "pager", "skip",
}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*)>",
    re.S | re.I,
)
NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
PART = re.compile(r"[a-z]+")

LEAST_IMPORTANCE, LEAST_PAGES = 0.3, 5
#: Step of a path to the text of an element itself.
LEAF = "#"


def names_of(attributes: str) -> tuple[str, bool, bool]:
    """Class, id and role as one label, whether they tell noise, and whether the element is hidden."""
    if not attributes.strip():
        return "", False, False
    label = " ".join(a or b or c for _, a, b, c in NAMED.findall(attributes)).lower()
    return label, any(x in NOISE for x in PART.findall(label)), bool(HIDDEN.search(attributes))


def lifted(found: list[tuple], in_article: list[bool]) -> set[int]:
    """Marks of noise that don't hold, as their branch has the page's articles or most of its text; outer marks first.

    ``in_article``: whether the mark stands in an article itself.
    """
    total, out = sum(len(b[0]) for b in found), set()
    while True:
        live, size, articles = False, Counter(), set()
        for text, _, inside, _, marks in found:
            mark = next((m for m in marks if m not in out), None)
            if mark is None:
                live = live or inside
            elif not in_article[mark]:
                size[mark] += len(text)
                if inside:
                    articles.add(mark)
        more = {m for m, n in size.items() if 2 * n > total or (m in articles and not live)}
        if not more:
            return out
        out |= more


def blocks(page: str) -> list[tuple[str, str, bool, str]]:
    """(text, path, inside, children): the blocks that may be content, in page order.

    ``inside``: whether it lies in an article, then all do; ``children`` names the block's inline elements, its presentation.
    """
    out: list[tuple[str, str, bool, str, tuple]] = []
    stack: list[tuple[str, str, bool, bool, tuple]] = []  # element, path step, dropped, in the article, marks of noise
    marked_in_article: list[bool] = []  # by mark
    text: list[str] = []
    children: list[str] = []

    def flush() -> None:
        joined = " ".join(html.unescape("".join(text)).split())
        if joined and not (stack and stack[-1][2]):
            inside, marks = stack[-1][3:] if stack else (False, ())
            out.append((joined, "/".join(s[1] for s in stack if s[0] not in INLINE), inside, ",".join(children), marks))
        text.clear()
        children.clear()

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            above = stack[-2] if len(stack) > 1 else ("", "", False, False, ())
            if stack[-1][0] not in INLINE or stack[-1][2] != above[2] or stack[-1][4] != above[4]:
                flush()
            stack.pop()

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = m.group(3) or m.group(6)
        if not tag:
            if m.group(1):
                text.append(" ")
            continue
        tag, closing, attributes = tag.lower(), m.group(2) or m.group(5), m.group(4) or m.group(7) or ""
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                pop_to(depth)
            continue
        if tag == "br":
            text.append(" ")
            continue
        inline = tag in INLINE
        if not inline:
            flush()
            if tag in VOID:
                continue
            if tag in CLOSES:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in CLOSES[tag]:
                        pop_to(i)
                    elif stack[i][0] not in INLINE and stack[i][0] != "p":
                        break
            else:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        pop_to(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
        else:
            children.append(tag)
            if tag in VOID:
                continue
        label, noise, hidden = names_of(attributes)
        dropped, inside, marks = stack[-1][2:] if stack else (False, False, ())
        if tag in ARTICLE:
            inside = True
        elif tag not in ("html", "body"):
            gone = hidden or (tag in SKIPPED and tag != "form") or (tag == "header" and not inside)
            mark = not gone and (noise or tag == "form")
            if inline and not dropped and (gone or mark):
                flush()
            dropped = dropped or gone
            if mark and not dropped:
                marks = (*marks, len(marked_in_article))
                marked_in_article.append(inside)
        step = f"{tag}.{label.replace('/', '|')}" if label else tag
        stack.append((tag, step, dropped, inside, marks))
    if at < len(page):
        text.append(page[at:])
    pop_to(0)
    flush()
    if marked_in_article:
        free = lifted(out, marked_in_article)
        out = [b for b in out if all(m in free for m in b[4])]
    if any(b[2] for b in out):
        out = [b for b in out if b[2]]
    return [b[:4] for b in out]


def hash64(parts) -> int:
    """Signed 64-bit hash of a row of strings."""
    data = "\0".join(parts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def place(path: str, inside: bool) -> tuple[list[str], str]:
    """Steps to the element whose text a block is, and the steps of headings and plain paragraphs below it in an article."""
    steps = path.split("/") if path else []
    own = len(steps)
    while inside and own and (steps[own - 1] in CONTENT or steps[own - 1].split(".", 1)[0] in HEADINGS):
        own -= 1
    return steps[:own], "/".join(steps[own:])


def nodes_of(found: list[tuple[str, str, bool, str]]) -> tuple[list[str], list[tuple[str, int, int]]]:
    """The leaf of every block, and (path, content, style) of the page's nodes: of each, hashes of all that the page has there."""
    leaves: list[str] = []
    at: dict[str, tuple[list[str], list[str]]] = {}
    for text, path, inside, children in found:
        steps, below = place(path, inside)
        content = str(hash64([text]))
        node = ""
        for k, step in enumerate(steps):
            node = f"{node}/{step}" if k else step
            contents, styles = at.setdefault(node, ([], []))
            child = steps[k + 1] if k + 1 < len(steps) else LEAF
            contents.append(content)
            if not styles or styles[-1] != child:
                styles.append(child)
        leaves.append(f"{node}/{LEAF}")
        contents, styles = at.setdefault(leaves[-1], ([], []))
        contents.append(content)
        styles.append(f"{below} {children}")
    return leaves, [(node, hash64(contents), hash64(styles)) for node, (contents, styles) in at.items()]


NODE = pa.struct([("path", pa.string()), ("content", pa.int64()), ("style", pa.int64())])
PARSED = "text array<string>, leaf array<string>, inside boolean, page long, nodes array<struct<path: string, content: long, style: long>>"


def parse(batches):
    """Pages to their blocks and to the nodes of the style tree; ``page`` is a hash of the page's texts, equal for copies."""
    for batch in batches:
        rows = [blocks(page) for page in batch.column("html").to_pylist()]
        leaves, nodes = zip(*map(nodes_of, rows)) if rows else ((), ())
        texts = [[b[0] for b in row] for row in rows]
        columns = [
            pa.array(texts, pa.list_(pa.string())),
            pa.array(leaves, pa.list_(pa.string())),
            pa.array([any(b[2] for b in row) for row in rows], pa.bool_()),
            pa.array([hash64(t) for t in texts], pa.int64()),
            pa.array([[dict(zip(("path", "content", "style"), n)) for n in row] for row in nodes], pa.list_(NODE)),
        ]
        kept = [c for c in batch.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=[*kept, "text", "leaf", "inside", "page", "nodes"])


def importance(parsed: DataFrame) -> DataFrame:
    """(host, path, n, importance) of every node of the sites' style trees; n counts different pages."""
    seen = parsed.select("host", "page", F.explode("nodes").alias("node"))
    kind = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"node.{k}").alias("feature")) for k in ("content", "style")])).alias("k")
    pages = seen.select("host", F.col("node.path").alias("path"), "page", kind).select("host", "path", "k.kind", "k.feature", "page").distinct()
    features = pages.groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).alias("n"))
    # H = log N - sum(n log n) / N, from sums that combine before the shuffle
    per_kind = features.groupBy("host", "path", "kind").agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    entropy = F.when(F.col("total") > 1, 1 - F.col("nlogn") / F.col("total") / F.log("total")).otherwise(1.0)
    return per_kind.groupBy("host", "path").agg(F.max("total").alias("n"), F.avg(entropy).alias("importance"))


def pruned(parsed: DataFrame, low: DataFrame) -> DataFrame:
    """The pages without the blocks at or below the nodes ``low`` (host, path), a written table; pages of articles that hold most of their text there stay."""
    cells = parsed.select("row", "host", F.explode("nodes.path").alias("path"))
    gone = settle(cells.join(low, ["host", "path"]).groupBy("row").agg(F.collect_set("path").alias("gone")))
    falls = F.transform("leaf", lambda at: F.exists("gone", lambda g: (at == g) | at.startswith(F.concat(g, F.lit("/")))))
    zero = F.lit(0).cast("long")
    lost = F.aggregate(F.zip_with("text", "falls", lambda t, f: F.when(f, F.length(t)).otherwise(0)), zero, lambda a, x: a + x)
    whole = F.aggregate("text", zero, lambda a, t: a + F.length(t))
    left = F.filter(F.zip_with("text", "falls", lambda t, f: F.when(~f, t)), lambda t: t.isNotNull())
    rows = parsed.select("id", "url", "row", "text", "leaf", "inside").join(gone, "row", "left").withColumn("falls", F.when(F.col("gone").isNotNull(), falls))
    holds = F.col("gone").isNotNull() & ~(F.col("inside") & (lost * 2 > whole))
    return rows.select("id", "url", F.when(holds, left).otherwise(F.col("text")).alias("text"))


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: float = LEAST_IMPORTANCE,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    kind = dict(pages.dtypes)[id_col]
    host = F.coalesce(F.regexp_extract(F.lower(url_col), r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        host.alias("host"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    parsed = settle(rows.mapInArrow(parse, f"id {kind}, url string, host string, row long, {PARSED}"))
    low = settle(importance(parsed).where((F.col("n") >= least_pages) & (F.col("importance") < least)).select("host", "path"))
    kept = parsed if low.isEmpty() else pruned(parsed, low)
    out = kept.select("id", "url", F.array_join("text", " ").alias("text"))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
