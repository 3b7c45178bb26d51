"""Main text of web pages, from the template that pages of one host share.

A token is an element by its path of tags and classes. Its occurrence vector says how often it stands on each
page of the host; tokens with one vector form an equivalence class. A class is valid if it covers enough pages
of the host; valid classes nest by their paths and make up the template. What lies between template tokens is
a slot. A class that stands several times on a page, unlike the frame that the outermost token belongs to, is a part that
repeats inside a slot and none itself, unless it is an article or main element. Slots whose token marks furniture (menus, adverts, forms, hidden parts ...) are dropped, and so are blocks that
stand in the same slot on all pages of a host that has FIXED_PAGES or more. Of the slots with nearly all the text that is left, one is chosen: an
article element before a main element before the innermost. Its blocks are extracted from every page of the host, in
page order, whatever number of articles they belong to.

Vectors are compared by a hash that is combined per (host, token), so a host with a third of all pages sends one
row per token and task. The template of a host is a row; only if all of them are small does Spark broadcast
them.

Meaning of odd input: null or empty html gives an empty text; a null or odd url belongs to the host ''; a page
without the host's slot falls back to its own article, main or body; repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitloom.llm import tokens as tk
from transitloom.llm.graph import stored
from transitloom.llm.rows import small_batches

#: Elements by what they do (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg math object canvas audio video title".split())
BLOCK = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption"
).split())
FURNITURE = frozenset("nav header footer aside form script style button select dialog menu head".split())
#: Words of a class, id or role that mark furniture (fixed values).
MARKS = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menus?|sidebar|side|footer|header|masthead|breadcrumbs?|cookies?|notices?|"
    r"consent|popup|modal|newsletter|subscribe|share|social|related|comments?|replies|respond|login|search|pagination|toolbar|widget)(?:[^a-z]|$)")
#: What an opening tag closes by implication.
CLOSES = {t: ("p",) for t in BLOCK} | {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
                                       "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
#: Elements beyond which an implied end does not reach.
FENCES = frozenset("ul ol dl table article section div main body html td th blockquote aside nav header footer form".split())
#: The share of a host's pages that a valid class covers.
SUPPORT = 0.5
#: The share of a host's varying text that its slot holds.
NEARLY = 0.9

#: Pages of a host from which on a block that stands on all of them is taken for part of its template.
FIXED_PAGES = 4
#: Words that say nothing of what a part is (fixed values).
NEUTRAL = frozenset("area bar block bottom box button buttons container inline item items label left link links list right section slot top unit wrapper".split())

#: A tag without faults; any other is read sign by sign. Possessive repeats keep the search from going back.
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)((?:\s++[^\s\"'<>/=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'=<>`]++))?)*+)\s*+(/?)>")
_NAMED = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'=<>`]++)))?")
_NEXT = re.compile(r"[\s/]*+([^\s/>=]*+)\s*+(=?)\s*+")
_BARE = re.compile(r"[^\s>]++")
_HIDING = re.compile(r"display\s*:\s*none", re.I)
_DIGITS = re.compile(r"\d+")


@lru_cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>", re.I)


class _Element:
    __slots__ = ("tag", "path", "furniture", "article")

    def __init__(self, tag: str, path: str, furniture: bool, article: int) -> None:
        self.tag, self.path, self.furniture, self.article = tag, path, furniture, article


class Page:
    """One page: blocks (text, paths of its elements, number of its article, whether it is furniture) and elements."""

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[str, str, int, bool]] = []
        self.opened: Counter[str] = Counter()
        self.articles = 0
        self._stack = [_Element("", "", False, 0)]
        self._text: list[str] = []
        self._read(source)
        self._flush()

    def _flush(self) -> None:
        if self._text:
            # decoded once the block is whole, so a reference cannot be cut
            text = " ".join(entities.unescape("".join(self._text)).split())
            self._text.clear()
            if text:
                top = self._stack[-1]
                self.blocks.append((text, top.path, top.article, top.furniture))

    def _open(self, tag: str, attributes: dict[str, str]) -> None:
        closes = CLOSES.get(tag)
        if closes:
            for i in range(len(self._stack) - 1, 0, -1):
                if self._stack[i].tag in closes:
                    self._flush()
                    del self._stack[i:]
                    break
                if self._stack[i].tag in FENCES:
                    break
        if tag in BLOCK:
            self._flush()
        if tag in VOID:
            if tag == "br":
                self._text.append(" ")
            return
        top = self._stack[-1]
        names = " ".join(v for v in map(attributes.get, ("class", "id", "role")) if v).lower() if attributes else ""
        inside = top.article
        if tag == "article" and not top.furniture:
            self.articles += not inside
            inside = inside or self.articles
        # the heading of an article may stand in a header of its own
        marked = (tag in FURNITURE and not (tag == "header" and inside)) or (
            bool(names) and tag not in ("body", "html", "article", "main") and _is_furniture(names, inside > 0))
        marked = marked or "hidden" in attributes or _HIDING.search(attributes.get("style", "")) is not None
        path = top.path
        if tag in BLOCK and tag not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "td", "th", "dt", "dd"):
            path = f"{path}/{tag}" + (f".{_DIGITS.sub('0', '.'.join(sorted(names.split())))}" if names else "")
            self.opened[path] += 1
        self._stack.append(_Element(tag, path, top.furniture or marked, inside))

    def _close(self, tag: str) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag == tag:
                if tag in BLOCK or any(e.tag in BLOCK for e in self._stack[i:]):
                    self._flush()
                del self._stack[i:]
                return

    def _read(self, source: str) -> None:
        """One pass from left to right: what has no end takes the rest of the page, so nothing is read twice."""
        at, n = 0, len(source)
        while at < n:
            sign = source.find("<", at)
            if sign != at:
                self._text.append(source[at : sign if sign >= 0 else n])
            if sign < 0:
                return
            found = _TAG.match(source, sign + 1)
            if found:
                end, closes = found.end(), bool(found[4])
                attributes = _attributes(found[3]) if found[3] else {}
            else:
                found = _NAMED.match(source, sign + 1)
                if found is None:
                    at = self._other(source, sign)
                    continue
                attributes, closes, end = _read_tag(source, found.end())
            at, tag = end, found[2].lower()
            if found[1]:
                self._close(tag)
            elif tag in RAW and not closes:
                last = _raw_end(tag).search(source, at)
                at = last.end() if last else n
            else:
                self._open(tag, attributes)

    def _other(self, source: str, sign: int) -> int:
        """Comments and declarations, and a sign that opens nothing; returns where reading goes on."""
        if source.startswith("<!--", sign):
            end = source.find("-->", sign + 4)
            return end + 3 if end >= 0 else len(source)
        if source[sign + 1 : sign + 2] in ("!", "?", "/") and source[sign + 1 : sign + 2]:
            end = source.find(">", sign)
            return end + 1 if end >= 0 else len(source)
        self._text.append("<")
        return sign + 1

    def main(self, slot: str | None, fixed: list[int] | None = None) -> str:
        """The blocks of the host's slot that are not fixed, or else of the page's own articles, main or body, joined by line ends."""
        blocks = [b for b in self.blocks if not b[3]]
        taken = [b for b in blocks if slot and (b[1] == slot or b[1].startswith(slot + "/"))]
        if taken and fixed:
            never = set(fixed)
            taken = [b for b in taken if block_key(b[1], b[0]) not in never] or taken
        if not taken and self.articles:
            taken = [b for b in blocks if b[2]]
        if not taken:
            taken = [b for b in blocks if "/main" in b[1]] or blocks
        return "\n".join(b[0] for b in taken)


def _attributes(text: str) -> dict[str, str]:
    """The attributes of a tag without faults; of several of one name the first counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), "".join(values))
    return out


def _read_tag(source: str, at: int) -> tuple[dict[str, str], bool, int]:
    """Attributes of a tag whose name ends at a place, whether it closes itself, and where it ends.

    Quotes count after an equals sign only, so a stray one is part of a name. A tag or value without an end takes the
    rest of the page.
    """
    out: dict[str, str] = {}
    n = len(source)
    while at < n:
        found = _NEXT.match(source, at)
        name, value, at = found[1].lower(), "", found.end()
        if found[2] and at < n:
            if source[at] in "\"'":
                end = source.find(source[at], at + 1)
                if end < 0:
                    return out, False, n
                value, at = source[at + 1 : end], end + 1
            elif source[at] != ">":
                bare = _BARE.match(source, at)
                value, at = bare[0], bare.end()
        if name:
            out.setdefault(name, value)
        if at < n and source[at] == ">":
            return out, source[at - 1] == "/", at + 1
    return out, False, n


def _is_furniture(names: str, inside: bool) -> bool:
    """Whether class, id and role speak of furniture; within an article only names that say nothing else."""
    if not inside:
        return MARKS.search(names) is not None
    for name in names.split():
        parts = [p for p in re.split(r"[^a-z]+", name) if p and p not in NEUTRAL]
        if parts and all(MARKS.fullmatch(p) for p in parts):
            return True
    return False


def block_key(path: str, text: str) -> int:
    """A hash of a block and of where it stands."""
    return int.from_bytes(hashlib.blake2b(f"{path}\n{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def tokens(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """(host, page, path, n, place, chars, same, furniture, keys, sizes): the elements of each page, one row per path.

    ``chars`` is the text in it that is not furniture; ``keys`` and ``sizes`` tell the distinct blocks right below it.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "page", "path", "n", "place", "chars", "same", "furniture", "keys", "sizes"]
        for batch in tk.groups(batches, "_html"):
            out: list[list] = [[] for _ in names]
            for where, page, text in zip(*(c.to_pylist() for c in batch.columns)):
                seen = Page(text or "")
                inside: dict[str, list[str]] = {}
                marked = {p for _, p, _, furniture in seen.blocks if furniture}
                open_: Counter[str] = Counter()
                own: dict[str, dict[int, int]] = {}
                for block, path, _, furniture in seen.blocks:
                    if path and not furniture:
                        own.setdefault(path, {})[block_key(path, block)] = len(block)
                    while path:
                        open_[path] += 0 if furniture else len(block)
                        inside.setdefault(path, []).append(block)
                        path = path.rpartition("/")[0]
                for place, (path, n) in enumerate(seen.opened.items()):
                    whole = "\n".join(inside.get(path, ()))
                    same = _hash(whole)
                    for column, value in zip(out, (where, page, path, n, place, open_[path], same, path in marked, list(own.get(path, ())), list(own.get(path, {}).values()))):
                        column.append(value)
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    rows = pages.select(host(F.col(url)).alias("host"), F.xxhash64(url, source).alias("page"), F.col(source).alias("_html"))
    return rows.mapInArrow(run, "host string, page long, path string, n int, place int, chars long, same long, furniture boolean, keys array<long>, sizes array<int>")


def _hash(text: str) -> int:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    whole = tk.Words(())
    return int(whole.hashes(data, np.array([0]), np.array([len(data)])).view(np.int64)[0]) if len(data) else 0


def templates(found: DataFrame) -> DataFrame:
    """(host, path, parent, vector, pages, chars, furniture, fixed): the tokens of the valid classes of each host.

    ``vector`` names the class, ``parent`` the class of the nearest enclosing template token.
    """
    by_token = found.groupBy("host", "path").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("pages"), F.max("n").alias("most"),
        F.avg("place").alias("place"), F.sum("chars").alias("chars"), F.max("furniture").alias("furniture"),
        (F.min("same") == F.max("same")).alias("fixed"),
    )
    by_token = by_token.withColumn("host_pages", F.max("pages").over(Window.partitionBy("host")))
    classes = by_token.groupBy("host", "vector").agg(F.count("*").alias("tokens"))
    valid = by_token.join(classes, ["host", "vector"]).filter(F.col("pages") >= F.col("host_pages") * SUPPORT)
    up = valid.select("host", F.col("path").alias("_up"), F.col("vector").alias("parent"))
    parent = F.regexp_replace("path", r"/[^/]*$", "")
    return valid.withColumn("_up", parent).join(up, ["host", "_up"], "left").select(
        "host", "path", "parent", "vector", "tokens", "pages", "host_pages", "most", "place", "chars", "furniture", "fixed")


def fixed_blocks(found: DataFrame, template: DataFrame) -> DataFrame:
    """(host, path, key, chars): blocks that stand at one path on all pages of their host, FIXED_PAGES at least."""
    blocks = found.select("host", "path", F.explode(F.arrays_zip("keys", "sizes")).alias("b")).groupBy("host", "path", "b.keys").agg(
        F.count("*").alias("n"), F.first("b.sizes").alias("size"))
    pages = template.groupBy("host").agg(F.max("host_pages").alias("host_pages"))
    return blocks.filter(F.col("n") >= FIXED_PAGES).join(pages, "host").filter("n >= host_pages").select(
        "host", "path", F.col("keys").alias("key"), (F.col("n") * F.col("size")).alias("chars"))


def slots(template: DataFrame, fixed: DataFrame) -> DataFrame:
    """(host, slot, fixed): where the article of each host's pages stands, and the blocks that never change."""
    steps = F.split("path", "/")
    around = F.transform(F.sequence(F.lit(2), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    still = fixed.select("host", "chars", F.explode(around).alias("path")).groupBy("host", "path").agg(F.sum("chars").alias("still"))
    left = template.join(still, ["host", "path"], "left").withColumn("chars", F.col("chars") - F.coalesce("still", F.lit(0)))
    last = F.regexp_extract("path", r"([^/.]*)[^/]*$", 1)
    rank = F.when(last == "article", 0).when(last == "main", 1).otherwise(2)
    # a repeated part would leave out what stands beside it
    frame = F.first("vector").over(Window.partitionBy("host").orderBy(F.length("path"), "path"))
    left = left.withColumn("repeated", (F.col("most") > 1) & (F.col("vector") != frame) & (rank == 2))
    open_ = left.filter(~F.col("repeated") & ~F.col("furniture") & (F.col("chars") > 0) & (~F.col("fixed") | (F.col("host_pages") == 1)))
    # text before names: only slots that hold nearly all that varies count, of others the innermost
    most = F.max("chars").over(Window.partitionBy("host"))
    open_ = open_.withColumn("rank", rank).withColumn("near", (F.col("chars") >= NEARLY * most))
    order = Window.partitionBy("host").orderBy(
        F.col("near").desc(), "rank", F.when(rank == 2, F.length("path")).otherwise(0).desc(), F.col("pages").desc(), F.col("chars").desc(), "path")
    chosen = open_.withColumn("first", F.row_number().over(order)).filter("first = 1").select("host", F.col("path").alias("slot"))
    return chosen.join(fixed.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("fixed")), "host", "left")


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), url: str = "url", source: str = "html") -> DataFrame:
    """The kept columns and ``text``, the main text of every page."""
    small_batches(pages.sparkSession)
    found = stored(tokens(pages, url, source), "elements")
    template = stored(templates(found), "template")
    chosen = stored(slots(template, fixed_blocks(found, template)), "slots").withColumnRenamed("host", "_host")
    rows = pages.select(*keep, host(F.col(url)).alias("_host"), F.col(source).alias("_html"))
    rows = rows.join(chosen, "_host", "left").select(*keep, F.col("slot").alias("_slot"), F.col("fixed").alias("_fixed"), "_html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.groups(batches, "_html"):
            where, never, texts = (batch.column(c).to_pylist() for c in ("_slot", "_fixed", "_html"))
            out = [Page(t or "").main(s, f) for s, f, t in zip(where, never, texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(out, pa.string())], [*keep, "text"])

    return rows.mapInArrow(run, rows.drop("_slot", "_fixed", "_html").schema.add("text", "string"))
