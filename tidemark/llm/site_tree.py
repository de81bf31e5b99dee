"""HTML extraction by a site style tree.

The pages of a host are merged into one tree: a node is a path of block elements with
their classes, and it holds how often each content stood there and how often each list of
child elements. Both give an entropy, relative to the largest possible one: near 0 for
what all pages repeat (templates), near 1 for what differs from page to page. A node's
importance is the larger of the two, weighed with what its markup says: navigation,
headers, footers, asides, forms, adverts and comments have none, whose content may differ
from page to page. Names that articles use too (notice, related, search), and ids in an
article, only lower it. Names are whole tokens of class and role, and outside articles of
an id. All else is judged
alike, inside an article or main element and outside of it. Branches of low importance are
removed from each page, and the rest is its text; inside an article only the contents that a
tenth of the node's pages share are, so what stands on few pages is kept there.

Pages of a host that are equal in all that is judged count once, and a node on fewer than
``LEAST_PAGES`` pages is judged by its markup alone. The counts are ordinary aggregates; what
goes back to the pages is, per host, the list of unimportant paths, one entry per style and
not per page, and at most ten contents of each path inside an article.

Text: character references are decoded, white space inside a block becomes one space,
blocks follow in page order with an empty line between. A line break is white space.

Cases: null or empty html has the empty text; an unclosed element ends with its parent, a
stray end tag is ignored; unclosed comments and scripts reach to the end; null urls are one
host; a result's name among the columns is replaced; repeated rows give repeated results.
"""

from __future__ import annotations

import html as references
import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import landed, small_batches, whole_text
from tidemark.operators.joins import join_under_skew

LEAST_PAGES = 5
LEAST_IMPORTANCE = 0.3
LEAST_REPEATED = 0.1
LOWERED = 0.5

# Fixed values of HTML: elements by how they are laid out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe textarea title audio video select annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var object canvas "
    # formulas
    "math semantics maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
    "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 p".split())
BARE = frozenset("nav footer aside form button menu dialog head".split())
MAIN = frozenset(("article", "main"))
# Names of menus, adverts, forms and comments, whose content may differ from page to page.
ROLES = frozenset(
    "ad ads advert adverts advertisement advertising sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer cookie cookies consent newsletter subscribe share sharing comment comments disqus replies respond toolbar pagination "
    "pager login signin signup".split()
)
ROLES_BY_ROLE = frozenset("navigation menu menubar toolbar search banner complementary contentinfo form dialog".split())
# Names that may be of articles too: they lower importance.
DOUBTFUL = frozenset(
    "sponsor promotion banner notice notices notification popup modal overlay subscription social related recommended reply "
    "search widget".split()
)
# Words that with a name make another name of the same: ad-slot, comment-list.
AROUND = frozenset(
    "area bar block box button buttons container inner item items left link links list main outer right section site slot top "
    "bottom unit wrap wrapper".split()
)
HEADER_ROLES = frozenset(("header", "masthead", "banner"))
CLOSED_BY = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"),
}
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>""", re.S)
NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@lru_cache(maxsize=4096)
def _marks(tag: str, attributes: str) -> tuple[str, frozenset[str], bool, bool, bool]:
    """The element's name in paths, its class, id and role tokens, and whether these name what no text has, by an id only, or doubtfully."""
    named: dict[str, list[str]] = {"class": [], "id": [], "role": []}
    for m in NAMES.finditer(attributes):
        named[m[1].lower()] += (m[2] or m[3] or m[4] or "").lower().split()
    every = [token for tokens in named.values() for token in tokens]
    words = {w for token in every for w in re.split(r"[^a-z]+", token) if w}

    def one_of(tokens: list[str], names: frozenset[str]) -> bool:
        """Whether a whole token is a name, alone or with words around it."""
        parts = [{w for w in re.split(r"[-_]+", token) if w} for token in tokens]
        return any(p & names and p <= names | AROUND for p in parts)

    bare = one_of(named["class"], ROLES) or bool(ROLES_BY_ROLE & set(named["role"]))
    by_id = tag not in HEADINGS and one_of(named["id"], ROLES)
    return ".".join([tag, *sorted(words)]), frozenset(every), bare, by_id, one_of(named["class"], DOUBTFUL)


class Block:
    __slots__ = ("path", "text", "inside", "bare", "doubtful")

    def __init__(self, path: str, text: str, inside: bool, bare: bool, doubtful: bool) -> None:
        self.path, self.text, self.inside, self.bare, self.doubtful = path, text, inside, bare, doubtful


def blocks(page: str) -> tuple[list[Block], dict[str, list[str]]]:
    """Text blocks in page order, and the child elements of each path."""
    # tag, path, in an article, without importance, of lower importance
    stack: list[tuple[str, str, bool, bool, bool]] = [("", "", False, False, False)]
    found: list[Block] = []
    children: dict[str, list[str]] = {}
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join(references.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                found.append(Block(text=text, **dict(zip(("path", "inside", "bare", "doubtful"), stack[-1][1:]))))

    def close(tags: tuple[str, ...]) -> None:
        if stack[-1][0] in tags:
            stack.pop()

    at, end = 0, len(page)
    while at < end:
        match = TAG.search(page, at)
        if not match:
            pieces.append(page[at:])
            break
        if match.start() > at:
            pieces.append(page[at:match.start()])
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if tag in INLINE:
            continue
        if tag in VOID:
            pieces.append(" ")
            if tag == "hr":
                flush()
            continue
        if match[1]:
            flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
            continue
        if tag in RAW:
            if not match[3].endswith("/"):
                closing = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = closing.end() if closing else end
            continue
        flush()
        close(("p",))
        for _ in range(3):
            close(CLOSED_BY.get(tag, ()))
        name, words, named, by_id, lower = _marks(tag, match[3])
        _, path, inside, bare, doubtful = stack[-1]
        plain = tag in BARE or named or (not inside and (by_id or tag == "header" or bool(words & HEADER_ROLES)))
        children.setdefault(path, []).append(name)
        # an id in an article may as well be the target of a link to a chapter
        stack.append((tag, f"{path}>{name}", inside or tag in MAIN or "main" in words, bare or plain, doubtful or lower or by_id))
    flush()
    return found, children


def _digest(text: str) -> int:
    return zlib.crc32(text.encode()) << 32 | zlib.adler32(text.encode())


def _contents(found: list[Block]) -> dict[tuple[str, bool, bool], int]:
    """Hash of what stands at each path, over the blocks that are judged; with whether it is in an article, and doubtful."""
    texts: dict[tuple[str, bool, bool], list[str]] = {}
    for block in found:
        if not block.bare:
            texts.setdefault((block.path, block.inside, block.doubtful), []).append(block.text)
    return {node: _digest("\n".join(own)) >> 1 for node, own in texts.items()}


def _nodes(pages: pa.Array) -> pa.Array:
    """Per page and path: hashes of its content and of its child elements."""
    rows = []
    for page in pages.to_pylist():
        found, children = blocks(page)
        rows.append([
            {"path": path, "inside": inside, "doubtful": doubtful, "content": content, "style": _digest(" ".join(children.get(path, ()))) >> 1}
            for (path, inside, doubtful), content in _contents(found).items()
        ])
    kinds = [("path", pa.string()), ("inside", pa.bool_()), ("doubtful", pa.bool_()), ("content", pa.int64()), ("style", pa.int64())]
    return pa.array(rows, pa.list_(pa.struct(kinds)))


def main_text(page: str, unimportant: set[str]) -> str:
    """``unimportant``: paths, or paths with one content of theirs where they are inside an article."""
    found, _ = blocks(page)
    contents = _contents(found)
    low = {
        path for (path, inside, _), content in contents.items()
        if (f"{path}\n{content}" if inside else path) in unimportant
    }
    return "\n\n".join(b.text for b in found if not b.bare and b.path not in low)


def nodes(pages: DataFrame) -> DataFrame:
    """host, page, path, inside, doubtful, content, style of every judged node; ``pages`` has host and html."""
    small_batches(pages.sparkSession)
    node = F.arrow_udf(_nodes, "array<struct<path:string,inside:boolean,doubtful:boolean,content:bigint,style:bigint>>")
    rows = pages.select("host", node("html").alias("nodes"))
    each = rows.select("host", F.xxhash64("nodes").alias("page"), F.inline("nodes")).distinct()
    return landed(each, "nodes")


def unimportant(each: DataFrame) -> DataFrame:
    """host, entry: what is removed from the pages of a host, as ``main_text`` reads it."""
    node = ["host", "path", "inside", "doubtful"]

    def entropy(value: str) -> DataFrame:
        """From the sums of n and n log n over the values of a node."""
        counts = each.groupBy(*node, value).agg(F.count("*").alias("n"))
        sums = counts.groupBy(*node).agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
        by = F.when(F.col("m") > 1, 1 - F.col("s") / F.col("m") / F.log("m")).otherwise(1.0)
        return sums.select(*node, "m", by.alias(f"by_{value}"))

    both = entropy("content").join(entropy("style").drop("m"), node)
    importance = F.greatest("by_content", "by_style") * F.when(F.col("doubtful"), LOWERED).otherwise(1.0)
    low = both.filter((F.col("m") >= LEAST_PAGES) & (importance < LEAST_IMPORTANCE))
    # before the join, so that a large host brings few rows to it
    repeated = each.filter("inside").groupBy(*node, "content").agg(F.count("*").alias("n")).filter("n > 1")
    often = repeated.join(low.select(*node, "m"), node).filter(F.col("n") >= F.col("m") * LEAST_REPEATED)
    entry = F.concat("path", F.lit("\n"), F.col("content").cast("string"))
    return low.filter("not inside").select("host", F.col("path").alias("entry")).union(often.select("host", entry.alias("entry")))


def extracted(pages: DataFrame, url_column: str = "url", html_column: str = "html", result: str = "text") -> DataFrame:
    """All columns, and the page's main text."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_column), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)), F.lit(""))
    low = unimportant(nodes(pages.select(host.alias("host"), whole_text(html_column).alias("html"))))
    listed = landed(low.groupBy("host").agg(F.collect_list("entry").alias("unimportant")), "unimportant")

    def run(pages: pa.Array, lists: pa.Array) -> pa.Array:
        both = zip(pages.to_pylist(), lists.to_pylist())
        return pa.array([main_text(page, set(paths or ())) for page, paths in both], pa.string())

    rows = pages.drop(result) if result in pages.columns else pages
    # everything the caller has stays in one column, so no name can clash
    kept = rows.select(F.struct("*").alias("row"), host.alias("host"))
    text = F.arrow_udf(run, "string")(whole_text(f"row.{html_column}"), F.col("unimportant"))
    return join_under_skew(kept, listed, ["host"]).select("row.*", text.alias(result))
