"""Main text of web pages by equivalence classes of template tokens.

Tokens of a page are its tags, told apart by the path of open elements, and
its text nodes, told apart by path and content.  Per host, a token's
occurrence vector is its count in every page; tokens with equal vectors form
an equivalence class.  A class is kept if it occurs in a stated share (the
support) of the host's different pages that hold any token, and there are
enough of these for that to mean something.  The largest class of tokens that
occur once a page, in the same order, is the skeleton; classes that repeat
(list items, table rows) nest in the slot of the skeleton that holds all their
paths.  A page is then read slot by slot: the text nodes that belong to a
class are the template's own, inside the article too, the others are the
page's data, and the slots that hold the article are extracted.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.store import bounded_batches, table

# Element names.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = "script|style|noscript|template|svg|textarea|iframe|title"
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
UNCLOSED = frozenset("p li dt dd tr td th option tbody thead tfoot colgroup".split())
_CELLS, _GROUPS = ("td", "th"), ("tbody", "thead", "tfoot", "colgroup")
ENDS = {"p": ("p",), "li": ("li",), "option": ("option",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": _CELLS, "th": _CELLS,
        "tr": (*_CELLS, "tr"), **dict.fromkeys(_GROUPS, (*_CELLS, "tr", *_GROUPS))}  # open elements that a start tag ends
DROPPED = frozenset("aside button dialog fieldset footer form head menu nav select".split())
CONTENT = frozenset(("article", "main"))
KEPT = frozenset(("article", "main", "html", "body"))  # never left out for their attributes
# Words in class, id and role attributes that mark other matter: as
# a part of a name, and inside an article or main element only as a whole name.
MARKS = frozenset("ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer masthead menu "
                  "modal nav navbar navigation newsletter notice notices pager pagination popup promo related share sharing sidebar social sponsor sponsored subscribe widget".split())

# Attributes: a quote opens a value behind "=" only, and nothing is tried twice (possessive). The pattern is
# applied up to the last ">" only, so every tag that it begins also ends: a page is read once
_INSIDE = r"(?:=\s*+\"[^\"]*\"|=\s*+'[^']*'|[^>])*+"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b{_INSIDE}>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9-]*)({_INSIDE})>|<[!?][^>]*>|[^<]+|<", re.S | re.I)
_ENDED = re.compile(rf"-->\Z|</(?:{RAW})\s*>\Z", re.I)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
_BITS = (1 << 62) - 1
DEFAULT_LEAST_PAGES = 4
DEFAULT_SUPPORT = 0.9


def host_of(url: Column) -> Column:
    """Host in lower case; null URLs and those without host share the empty one."""
    found = F.regexp_extract(F.trim(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


class Node:
    """An open element: its name, its path and whether it is left out."""
    __slots__ = ("name", "path", "dropped", "content")

    def __init__(self, name: str, path: str, dropped: bool, content: bool):
        self.name, self.path, self.dropped, self.content = name, path, dropped, content


def tokens(page: str) -> Iterator[tuple[str, str | None, Node, bool]]:
    """``(token, text, element, breaks)`` in page order: ``text`` for text
    nodes (None for tags), ``breaks`` if the tag ends a block of text."""
    stack, end, hit = [Node("", "", False, False)], page.rfind(">") + 1, None
    for hit in _TOKEN.finditer(page, 0, end):
        closing, name = hit.group(2), hit.group(3)
        whole = hit.group()
        if name is None:
            if whole[0] != "<" or whole == "<":
                top = stack[-1]
                yield "", whole, top, False
            continue
        name = name.lower()
        if closing:
            if name in INLINE or name in VOID:
                yield "", None, stack[-1], name == "br"
                continue
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if at:
                node = stack[at]
                del stack[at:]
                yield f"{node.path}/", None, stack[-1], True
            else:
                yield "", None, stack[-1], True
            continue
        if name in VOID or name in INLINE:
            yield f"{stack[-1].path}>{name}", None, stack[-1], name in ("br", "hr")
            continue
        if name not in UNCLOSED and stack[-1].name == "p":
            stack.pop()
        while stack[-1].name in ENDS.get(name, ()):
            stack.pop()
        parent, marks, names = stack[-1], [], []
        for a in _ATTRIBUTE.finditer(hit.group(4) or ""):
            value = (a.group(2) or a.group(3) or a.group(4) or "").lower()
            marks += re.split(r"[^a-z0-9]+", value)
            names += value.split()
        content = parent.content or name in CONTENT
        dropped = (parent.dropped or name in DROPPED or (name == "header" and not parent.content)
                   or (name not in KEPT and not MARKS.isdisjoint(names if parent.content else marks)))
        node = Node(name, f"{parent.path}>{name}" + "".join(f".{m}" for m in sorted(set(marks)) if m and not m.isdigit()), dropped, content)
        if not hit.group(4).endswith("/"):
            stack.append(node)
        yield node.path, None, node, True
    # behind the last ">" there is only text, unless a comment, script or the like is open
    cut = hit is not None and (hit.group(1) or hit.group().startswith("<!--")) and not _ENDED.search(hit.group())
    if end < len(page) and not cut:
        yield "", page[end:], stack[-1], False


def _named(token: str, text: str | None, node: Node) -> str | None:
    """The token's name in its occurrence vector; None for white space."""
    if text is None:
        return token or None
    text = _SPACE.sub(" ", text).strip()
    return f"{node.path}={xxhash.xxh64_hexdigest(text)}" if text else None


def token_table(pages: DataFrame) -> DataFrame:
    """``(host, token, pages, vector, place, most)`` from ``(host, html, page)``:
    the pages that hold the token, a sum that stands for its occurrence vector,
    the sum of its first places and its highest count in a page.

    A page's entry in the vector is a 62-bit hash of the page and the count,
    added modulo 2^62 in partial sums, so no vector is ever gathered.  The
    token ``*`` occurs once in every page that holds any token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], list] = {}
            for host, page, key in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "page"))):
                counts, place = {}, {}
                for i, (token, text, node, _) in enumerate(tokens(page or "")):
                    name = _named(token, text, node)
                    if name:
                        counts[name] = counts.get(name, 0) + 1
                        place.setdefault(name, i)
                if counts:
                    counts["*"], place["*"] = 1, 0
                entries = {n: xxhash.xxh64_intdigest(f"{key} {n}") for n in set(counts.values())}
                for name, n in counts.items():
                    entry = found.setdefault((host, name), [0, 0, 0, 0])
                    entry[0] += 1
                    entry[1] = (entry[1] + entries[n]) & _BITS
                    entry[2] += place[name]
                    entry[3] = max(entry[3], n)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
                                              *(pa.array([v[i] for v in found.values()], pa.int64()) for i in range(4))],
                                             ["host", "token", "pages", "vector", "place", "most"])

    vector = (F.sum(F.col("vector").cast("decimal(38,0)")) % F.lit(_BITS + 1)).cast("long")
    return (pages.select("host", "html", "page").mapInArrow(run, "host string, token string, pages long, vector long, place long, most long")
            .groupBy("host", "token").agg(F.sum("pages").alias("pages"), vector.alias("vector"), F.sum("place").alias("place"), F.max("most").alias("most")))


def templates(pages: DataFrame, least_pages: int = DEFAULT_LEAST_PAGES, support: float = DEFAULT_SUPPORT) -> DataFrame:
    """``(host, once, tokens)`` per host with at least ``least_pages`` different
    pages that hold any token: the tokens ``(token, vector, place, most)`` of
    its equivalence classes, and the vector of its skeleton, the largest class
    of those that occur once a page.  Equal pages of a host count once.  Only
    tokens in at least ``support`` of these pages are in a class, so a host's
    row is bounded by the mean page over ``support``."""
    keyed = pages.select(host_of(F.col("url")).alias("host"), "html", F.xxhash64("html").alias("page"))
    stats = table(token_table(keyed.where("html is not null").dropDuplicates(["host", "page"])), "page-tokens")
    hosts = table(stats.where("token = '*'").select("host", F.col("pages").alias("_all")).where(F.col("_all") >= least_pages), "hosts")
    common = table(stats.where("token <> '*'").join(hosts, "host").where(F.col("pages") >= F.lit(support) * F.col("_all")), "common-tokens")
    classes = table(common.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("_size"), F.max("most").alias("_most"), F.max("pages").alias("_pages")), "token-classes")
    skeletons = classes.where("_most = 1").groupBy("host").agg(F.max_by("vector", F.struct("_size", "_pages", "vector")).alias("once"))
    valid = common.join(classes.where("_most = 1 or _size > 1").drop("_pages"), ["host", "vector"])
    found = valid.groupBy("host").agg(F.collect_list(F.struct("token", "vector", "place", "most")).alias("tokens"))
    return table(hosts.select("host").join(skeletons, "host", "left").join(found, "host").select("host", F.coalesce("once", F.lit(-1)).alias("once"), "tokens"), "templates")


def _left_out(path: str) -> bool:
    inside = False
    for part in path.split(">")[1:]:
        name, *marks = part.split(".")
        if name in DROPPED or name == "header" and not inside or name not in KEPT and not MARKS.isdisjoint(marks):
            return True
        inside = inside or name in CONTENT
    return False


def _in_content(path: str) -> bool:
    return any(part.split(".")[0] in CONTENT for part in path.split(">")[1:])


class Template:
    """Classes of one host: the skeleton in page order, the other classes that
    occur once a page, and the repeating ones, each nested in the slot of the
    skeleton that its tokens share."""

    def __init__(self, once: int | None, rows: list[dict]):
        rows = sorted(rows, key=lambda r: (r["place"], r["token"]))
        skeleton = [r["token"] for r in rows if r["vector"] == once]
        self.step = {t: i for i, t in enumerate(skeleton)}
        opened = [t for t in skeleton if "=" not in t and not t.endswith("/")]
        classes: dict[int, list[str]] = {}
        for r in rows:
            if r["vector"] != once and r["most"] > 1:
                classes.setdefault(r["vector"], []).append(r["token"])
        nested = [r["token"] for r in rows if r["vector"] != once and r["most"] == 1]
        for members in classes.values():
            homes = {max((o for o in opened if m.startswith(o + ">") or m.startswith(o + "=")), key=len, default="") for m in members}
            if len(homes) == 1:  # valid: one slot holds the whole class
                nested += members
        self.own = frozenset(t for t in (*skeleton, *nested) if "=" in t)  # text nodes of the template
        # slot i follows the skeleton's token i - 1; its path is that of the elements open there
        paths, at = [""], ""
        for t in skeleton:
            if "=" not in t:
                last = t.rsplit(">", 1)[-1].split(".")[0]
                at = t[:-1].rsplit(">", 1)[0] if t.endswith("/") else at if last in VOID or last in INLINE else t
            paths.append(at)
        self.bounded = any(_in_content(p) and not _left_out(p) for p in paths)
        self.slots = [not _left_out(p) and (_in_content(p) or not self.bounded) for p in paths]


def main_text(page: str, template: Template | None) -> str:
    """The page's article: the data of the template's article slots.  A page
    that lacks a token of the skeleton or has them in another order is read by
    its elements without the template's own text, and one whose host has no
    template by its elements alone."""
    rows = list(tokens(page))
    names = [_named(*r[:3]) for r in rows] if template else [None] * len(rows)
    ordered = template is not None and [template.step[n] for n in names if n in template.step] == list(range(len(template.step)))
    bounded = any(node.content and not node.dropped for _, text, node, _ in rows if text is None)
    slot, blocks, block = 0, [], []

    def close() -> None:
        text = _SPACE.sub(" ", html_entities.unescape("".join(block))).strip()
        if text:
            blocks.append(text)
        block.clear()

    for name, (_, text, node, breaks) in zip(names, rows):
        if ordered and name in template.step:
            slot += 1
        if text is None:
            if breaks:
                close()
        elif node.dropped or bounded and not node.content:
            close()
        elif ordered and not bounded and not template.slots[slot]:
            close()
        elif template and name in template.own and (not bounded or any(c.isalnum() for c in text)):  # marks between words are the article's
            close()
        else:
            block.append(text)
    close()
    return "\n".join(blocks)


def extract_main_text(pages: DataFrame, least_pages: int = DEFAULT_LEAST_PAGES, out_col: str = "text", support: float = DEFAULT_SUPPORT) -> DataFrame:
    """Add ``out_col`` with the main text of every page (page_id, url and html
    are read; a column called ``out_col`` is replaced).

    Where the page has an article or main element, its slots are the main
    text.  Marked elements (menus, asides, forms, adverts, comments and the
    like) are dropped, and so are the text nodes that the host's template owns,
    those of a class in at least ``support`` of its different pages, in the
    article or not.  Null and empty html give empty text and are no evidence;
    null and unreadable URLs form one host.  Repeated rows are pages of their
    own but count once as evidence.  An empty table stays empty.
    """
    bounded_batches(pages.sparkSession)
    found = templates(pages.select("page_id", "url", "html"), least_pages, support)
    rest = [c for c in pages.columns if c != out_col]
    page = pages.select(*rest, host_of(F.col("url")).alias("_host"))
    source = page.join(found.select(F.col("host").alias("_host"), F.col("once").alias("_once"), F.col("tokens").alias("_tokens")), "_host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[str, Template | None] = {}
        for batch in batches:
            texts, lists = [], batch.column("_tokens")
            for i, (html, host, once) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("html", "_host", "_once")))):
                if host not in made:
                    if len(made) > 200:
                        made.clear()
                    made[host] = Template(once, lists[i].as_py()) if once is not None else None
                texts.append(main_text(html or "", made[host]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(texts, pa.string())], [*rest, out_col])

    return source.mapInArrow(run, pages.select(*rest).schema.add(out_col, "string"))
