"""Main text of web pages: recurring element subtrees are deleted per host.

Each page's element subtrees are hashed (tag, text and children); Spark counts on how
many distinct pages of a host each hash occurs: copies of a page count once. A subtree
on at least MIN_PAGES pages and MIN_SHARE of the host's pages is template and is
deleted; MANY_PAGES are enough on a host of any size. No markup has to name it.

Never template are: an element around an article, or one inside it with half or more of
its text, as that is what the page is about even if copies of it recur; the page's only
text; and a paragraph, heading or other text block inside an article, at its ends too, as
articles may have sentences in common.

What the markup itself calls a menu, header, footer, sidebar, notice, advert, form,
script, style or comment goes too; inside an article only by names that mean nothing
else. An article's own header keeps its headings and nothing else, not a lead paragraph
either: headers do not count as main text. What is left of the article elements
(else of main, else of the body) is the text.

Reading a page takes time in proportion to its length, whatever is in it. Templates go
out by broadcast while they are at most MAX_BROADCAST rows, else by a join on the host.

Defined results: null or empty html, and pages without text, give the empty text; a url
without ``://`` has the empty host; broken markup is read as far as it goes: a ``<`` that
begins no tag is text, a last tag without its end is text-free, a quote without its end
is none; repeated
rows are read one by one; an empty table gives no rows; columns besides page_id, url and
html are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import materialise, prepare_workers
from tessera.llm.url_filter import host_of

MIN_PAGES = 3
MIN_SHARE = 0.05
MANY_PAGES = 20
MAX_BROADCAST = 200_000

# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe")
BLOCK = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("head script style noscript template textarea title iframe svg math nav header footer aside form menu dialog button select".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd td th figcaption summary".split())
#: An opening tag of the key closes open elements of these names.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: An opening tag of one of these closes an open paragraph.
ENDS_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "body", "html", "summary"}
SCOPE = frozenset("html body article main section div ul ol dl table aside nav header footer form td th blockquote".split())
#: A class or id of one of these, or of these and NEUTRAL words alone ("ad-box"), names what is not main text.
STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "cookie cookies consent popup modal newsletter comment comments commentlist reply replies disqus respond".split()
)
#: These do too, but not on a text block inside an article.
WEAK = frozenset("banner promotion footer header masthead notice notices overlay subscribe signup share sharing social related widget".split())
NEUTRAL = frozenset("area bar block bottom box button buttons container content inner item left links list main outer panel right section site top unit wrap wrapper".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())

TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
NAME = re.compile(r"[\s/]*+([^\s/>][^\s/>=]*+)?+(\s*+=\s*+)?+")
BARE = re.compile(r"[^\s>]*+")
#: A comment ends here; "<!-->" and "<!--->" have ended already.
SHORT, COMMENT_END = re.compile(r"-?>"), re.compile(r"--!?>")
RAW_END = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in RAW}
SPLIT = re.compile(r"[^a-z0-9]+")


class Node:
    __slots__ = ("attributes", "children", "framed", "hash", "size", "tag")

    def __init__(self, tag: str, attributes: list[tuple[str, str]] = []):  # noqa: B006
        self.tag, self.attributes, self.children, self.hash = tag, attributes, [], 0
        self.size, self.framed = 0, False  # characters that are not white or dropped; whether it is or holds an article


class _Reader:
    """Reads tags; remembers where no further quote of a kind is, so that each place is looked at once."""

    def __init__(self, page: str):
        self.page, self.end = page, {}

    def find(self, what: str, at: int) -> int:
        """Like str.find, but a search that has failed is not made again."""
        if at >= self.end.get(what, len(self.page) + 1):
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.end[what] = at
        return found

    def comment_end(self, at: int) -> int:
        """Where a comment ends whose inside begins here; the page's end if it does not."""
        m = SHORT.match(self.page, at)
        if m is None and at < self.end.get("--", len(self.page) + 1):
            m = COMMENT_END.search(self.page, at)
            if m is None:
                self.end["--"] = at
        return m.end() if m else len(self.page)

    def attributes(self, at: int) -> tuple[list[tuple[str, str]], bool, int]:
        """(class, id and role; whether it closes itself; where the tag ends), -1 if it does not."""
        page, out = self.page, []
        while True:
            m = NAME.match(page, at)
            at = m.end()
            name, value = m[1], ""
            if m[2]:
                if at < len(page) and (q := page[at]) in "\"'" and (end := self.find(q, at + 1)) >= 0:
                    value, at = page[at + 1 : end], end + 1
                else:
                    v = BARE.match(page, at)
                    value, at = v[0], v.end()
            if name and value and name.lower() in ("class", "id", "role"):
                out.append((name.lower(), value.lower()))
            if at >= len(page):
                return out, False, -1
            if page[at] == ">":
                return out, page[at - 1] == "/", at + 1


def parse(page: str) -> Node:
    """A tree of elements and decoded text; lenient with what is not closed."""
    root, reader = Node(""), _Reader(page)
    stack, open_tags, at, done = [root], Counter(), 0, 0

    def text(to: int) -> None:
        if to > done:
            stack[-1].children.append(html.unescape(page[done:to]))

    def close(names: tuple[str, ...], scope: frozenset) -> None:
        if not any(open_tags[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                open_tags.subtract(n.tag for n in stack[i:])
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    while (lt := page.find("<", at)) >= 0:
        if page.startswith("<!--", lt):
            text(lt)
            at = done = reader.comment_end(lt + 4)
            continue
        if page[lt + 1 : lt + 2] in ("!", "?"):
            text(lt)
            end = reader.find(">", lt)
            at = done = end + 1 if end >= 0 else len(page)
            continue
        m = TAG.match(page, lt + 1)
        if m is None:
            at = lt + 1  # a bare sign
            continue
        text(lt)
        attributes, alone, end = reader.attributes(m.end())
        if end < 0:  # all that follows belongs to a tag that does not end
            done = len(page)
            break
        at = done = end
        tag = m[2].lower()
        if m[1]:
            close((tag,), frozenset())
            continue
        if tag in ENDS_P:
            close(("p",), SCOPE)
        if tag in CLOSES:
            close(CLOSES[tag], frozenset(("ul", "ol", "dl", "table")))
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag in RAW_END:
            last = RAW_END[tag].search(page, at)
            end = reader.find(">", last.start()) if last else -1
            at = done = end + 1 if end >= 0 else len(page)
        elif tag not in VOID and not alone:
            stack.append(node)
            open_tags[tag] += 1
    text(len(page))
    return root


def dropped(node: Node, inside: bool = False) -> bool:
    """Whether the markup itself says that this is not main text; inside an article only by what means nothing else."""
    if node.tag in DROPPED:
        return True
    known = STRONG if inside and node.tag in TEXT_BLOCKS else STRONG | WEAK
    for name, value in node.attributes:
        if name == "role":
            if value in ROLES:
                return True
        elif node.tag not in ("html", "body", "article", "main") or "comment" in value:
            for word in value.split():
                parts = set(SPLIT.split(word)) - {""}
                if not parts.isdisjoint(known) and parts <= known | NEUTRAL:
                    return True
    return False


def digest(root: Node) -> None:
    """Sets the hash, size and framed of each node, children first."""
    order, todo = [], [(root, False)]
    while todo:
        node, inside = todo.pop()
        order.append((node, inside))
        inside |= node.tag in ("article", "main")
        todo += [(c, inside) for c in node.children if isinstance(c, Node)]
    for node, inside in reversed(order):
        h = xxhash.xxh64(node.tag.encode(), seed=7)
        for c in node.children:
            if isinstance(c, Node):
                h.update(c.hash.to_bytes(8, "little"))
                node.framed |= c.framed
                node.size += c.size
            else:
                words = c.split()
                h.update(b"\0" + " ".join(words).encode("utf-8", "replace"))
                node.size += sum(map(len, words))
        node.hash = h.intdigest()
        if dropped(node, inside):
            node.size, node.framed = 0, False
        elif node.tag in ("article", "main"):
            node.framed = True


def subtrees(root: Node) -> set[int]:
    """Hashes of the subtrees that may be template, wherever they stand: see the module's rules."""
    out, todo = set(), [(root, 0, False)]
    whole = 0 if root.framed else root.size  # without an article, no element holds all of the page's text
    while todo:
        node, most, inside = todo.pop()
        bulk = inside and 0 < most <= 2 * node.size or 0 < whole <= node.size
        quoted = inside and node.tag in TEXT_BLOCKS
        if not node.framed and not bulk and not quoted and node.tag not in ("", "html", "head", "body") and node.children and node.tag in BLOCK:
            out.add(node.hash)
        if node.tag in ("article", "main") and not (inside and node.tag == "main"):
            most, inside = node.size, True
        if not (inside and node.tag in TEXT_BLOCKS):
            todo += [(c, most, inside) for c in node.children if isinstance(c, Node)]
    return out


def _roots(root: Node, wanted: str, templates: frozenset) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if dropped(node) or node.hash in templates:
            continue
        if node.tag == wanted:
            out.append(node)
        else:
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def _headings(header: Node) -> list[Node]:
    out, todo = [], list(reversed(header.children))
    while todo:
        x = todo.pop()
        if isinstance(x, Node):
            if x.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                out.append(x)
            elif x.tag not in DROPPED:
                todo += reversed(x.children)
    return out


def _blocks(root: Node, templates: frozenset) -> list[str]:
    """The blocks of one root in order."""
    framed = root.tag in ("article", "main")
    blocks: list[list[str]] = [[]]
    todo: list = [root]
    while todo:
        x = todo.pop()
        if x is None:
            blocks.append([])
        elif isinstance(x, str):
            blocks[-1].append(x)
        elif framed and x.tag == "header" and x is not root:
            todo += reversed(_headings(x))
        elif not (dropped(x, framed) or x.hash in templates and x.tag not in ("", "html", "body", "article", "main")):
            if x.tag in BLOCK:
                blocks.append([])
                todo.append(None)
            todo += reversed(x.children)
    return [t for b in blocks if (t := " ".join("".join(b).split()))]


def main_text(root: Node, templates: frozenset) -> str:
    """The text of a digested tree without templates."""
    roots = _roots(root, "article", templates) or _roots(root, "main", templates) or [root]
    return " ".join(t for one in roots for t in _blocks(one, templates))


def _protected(root: Node, templates: frozenset) -> frozenset:
    """Templates that may be deleted here, even if a twin elsewhere may not."""
    return templates & frozenset(subtrees(root)) if templates else templates


def templates(pages: DataFrame) -> DataFrame:
    """(host, hash) of the subtrees that recur."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, hashes, own = [], [], []
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                root = parse(page)
                digest(root)
                found = [0, *subtrees(root)]  # 0 counts the page
                hosts += [host] * len(found)
                hashes += [h - (1 << 64) if h >> 63 else h for h in found]
                own += [root.hash - (1 << 63)] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(own, pa.int64())], ["host", "hash", "page"])

    counts = pages.mapInArrow(go, "host string, hash long, page long").distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
    counts = materialise(counts.where(f"hash = 0 OR n >= {MIN_PAGES}"), "subtrees")
    total = counts.where("hash = 0").select("host", F.col("n").alias("pages"))
    return materialise(counts.where("hash <> 0").join(total, "host").where(F.col("n") >= F.least(MIN_SHARE * F.col("pages"), F.lit(MANY_PAGES))).select("host", "hash"), "templates")


def extract(pages: DataFrame) -> DataFrame:
    """The rows of the op5 query: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    prepare_workers(spark)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    found = templates(rows.select("host", "html"))

    def text(page: str, known) -> str:
        root = parse(page)
        digest(root)
        return main_text(root, _protected(root, frozenset(h & 0xFFFFFFFFFFFFFFFF for h in known)))

    if found.count() <= MAX_BROADCAST:
        by_host: dict[str, list[int]] = {}
        for r in found.collect():
            by_host.setdefault(r.host, []).append(r.hash)
        shared = spark.sparkContext.broadcast(by_host)

        def go(hosts: pd.Series, htmls: pd.Series) -> pd.Series:
            return pd.Series([text(p, shared.value.get(h, ())) for h, p in zip(hosts, htmls, strict=True)], dtype=object)

        out = rows.select("page_id", "url", F.pandas_udf(go, "string")("host", "html").alias("text"))
    else:
        # Written first, so that both sides of the join are plain exchanges, which AQE splits where a host is hot.
        lists = materialise(found.groupBy("host").agg(F.collect_list("hash").alias("known")), "template-lists")

        def joined(knowns: pd.Series, htmls: pd.Series) -> pd.Series:
            return pd.Series([text(p, () if k is None else k.tolist()) for k, p in zip(knowns, htmls, strict=True)], dtype=object)

        out = rows.join(lists, "host", "left").select("page_id", "url", F.pandas_udf(joined, "string")("known", "html").alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
