"""HTML extraction by consensus host paths.

1. Every page is read into an outline: open elements, their generalised paths (tag and classes,
   digits folded), and the text outside boilerplate (navigation, headers, footers, asides,
   forms, adverts, notices, comments of readers, scripts, styles). Containers are scored by the
   text that is theirs, less links; the best one, widened to its article, gets the page's vote.
2. Votes are counted per (host, path) and the winner taken per host, both as aggregations with
   partial sums, so a host with a third of all pages is summed before the shuffle.
3. The winners are written; pages join them (broadcast only if that table measures small) and
   are extracted from all elements on the winning path. A page that lacks the path, or has no
   text there, falls back to its own best container, and without any container to its body.

Text: character references are decoded, white space inside a block becomes one space, blocks
are joined in page order by one space; nothing is cut.

Defined results: null or empty html gives an empty text; a null url is the empty host; broken
markup is read as far as it goes (an unclosed tag at the end is dropped); repeated pages vote
each and get a row each; ties in votes go to the larger score, then the greater path; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodstats.llm.common import materialise

#: A tag's attributes are read once, quoted values whole; if that finds no end of the tag (a
#: quote without a partner, a page cut off), it ends at the next ``>``, and without one it is
#: dropped. Nothing is tried twice, so time grows with the page's length.
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)(?:((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|([^>]*+)(>|\Z))"""
    r"""|<[!?][^>]*+(?:>|\Z)""", re.S)
_CLASS = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
                    re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I)
            for t in ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")}
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=\d)")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("""a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt
    rp s samp small span strike strong sub sup time tt u var wbr img""".split())
_CONTAINERS = frozenset("article main section div body td center".split())
_DROPPED_TAGS = frozenset("""head script style noscript template nav header footer aside form
    button select textarea iframe object svg canvas dialog menu noembed noframes xmp title
    audio video map""".split())
_DROPPED_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor
    sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer
    masthead cookie cookies consent gdpr notice notices alert popup modal overlay comment comments
    commentlist disqus reply replies respond share sharing social related recommended
    recommendations newsletter subscribe subscription signup login search toolbar widget widgets
    pagination pager copyright skip banner""".split())
_DROPPED_ROLES = frozenset("""navigation banner contentinfo complementary search alert dialog
    alertdialog form menu menubar toolbar""".split())
_CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
           "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")),
           "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}


class Outline:
    """Elements and text pieces of one page, in page order."""

    __slots__ = ("tags", "parents", "steps", "sizes", "articles", "pieces")

    def __init__(self) -> None:
        self.tags: list[str] = ["#page"]
        self.parents: list[int] = [-1]
        self.steps: list[str] = [""]            # an element's own part of its path
        self.sizes: list[int] = [0]             # length of its whole path
        self.articles: list[bool] = [False]     # "article" occurs on its path
        self.pieces: list[tuple[int, str, bool]] = []  # element, raw text, inside a link

    def add(self, tag: str, parent: int, classes: list[str]) -> int:
        step = ".".join((f">{tag}", *classes))
        self.tags.append(tag)
        self.parents.append(parent)
        self.steps.append(step)
        self.sizes.append(self.sizes[parent] + len(step))
        self.articles.append(self.articles[parent] or "article" in step)
        return len(self.tags) - 1

    def path(self, e: int) -> str:
        steps = []
        while e > 0:
            steps.append(self.steps[e])
            e = self.parents[e]
        return "".join(reversed(steps))

    def on_path(self, path: str) -> set[int]:
        """Elements with this path; paths are put together only where length and end agree."""
        return {e for e in range(1, len(self.tags)) if self.sizes[e] == len(path)
                and path.endswith(self.steps[e]) and self.path(e) == path}


def _drops(tag: str, attributes: str, in_article: bool) -> tuple[bool, list[str]]:
    """Whether an element is boilerplate, and its classes."""
    classes: list[str] = []
    if tag in _DROPPED_TAGS:
        return True, classes
    if not attributes or tag in ("html", "body"):
        return False, classes
    dropped = False
    for name, value in _CLASS.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            dropped = True
        elif name == "role":
            dropped |= value in _DROPPED_ROLES
        else:
            if name == "class":
                classes = sorted(set(_DIGITS.sub("#", value).split()))
            if tag not in ("article", "main"):
                parts = set(_PARTS.split(value))
                dropped |= not parts.isdisjoint(_DROPPED_NAMES) or "header" in parts and not in_article
    return dropped, classes


def outline(page: str) -> Outline:
    out = Outline()
    stack: list[tuple[str, int, bool, bool]] = [("#page", 0, False, False)]  # tag, element, dropped, link
    at, n = 0, len(page)
    pieces = out.pieces

    open_tags: dict[str, int] = {}  # how many of each tag are on the stack

    def close(to: int) -> None:
        for t, *_ in stack[to:]:
            open_tags[t] -= 1
        del stack[to:]

    while at < n:
        m = _TAG.search(page, at)
        upto = m.start() if m else n
        _, element, dropped, link = stack[-1]
        if upto > at and not dropped:
            pieces.append((element, page[at:upto], link))
        if not m:
            break
        at = m.end()
        tag = m[2]
        if not tag or m[5] == "":
            continue
        tag = tag.lower()
        if m[1]:  # an end tag closes what is open up to its element, if there is one
            for k in range(len(stack) - 1 if open_tags.get(tag) else 0, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            if tag not in _INLINE and not stack[-1][2]:
                pieces.append((stack[-1][1], " ", False))
            continue
        if tag not in _INLINE:
            if tag != "br":  # a block ends an open paragraph
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] not in _INLINE:
                        break
            if tag in _CLOSES:
                same, within = _CLOSES[tag]
                some = any(open_tags.get(t) for t in same.split())
                for k in range(len(stack) - 1 if some else 0, 0, -1):
                    if stack[k][0] in within:
                        break
                    if stack[k][0] in same.split():
                        close(k)
                        break
            if not stack[-1][2]:
                pieces.append((stack[-1][1], " ", False))
        if tag in _VOID:
            continue
        _, element, dropped, link = stack[-1]
        attributes = m[3] if m[4] is None else m[4]
        in_article = out.articles[element]
        own, classes = _drops(tag, attributes, in_article)
        dropped = dropped or own
        if tag in _CONTAINERS and not dropped:
            element = out.add(tag, element, classes)
        if tag in _RAW_END:
            at = _RAW_END[tag].search(page, at).end()
            continue
        if attributes.endswith("/") and tag in ("svg", "math"):
            continue
        stack.append((tag, element, dropped, link or tag == "a"))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    return out


def best_container(o: Outline) -> tuple[int, float]:
    """The element whose text is most likely the article, and its score; 0 for the page."""
    count = len(o.tags)
    own, linked, whole = [0.0] * count, [0.0] * count, [0.0] * count
    for element, text, link in o.pieces:
        size = len(text) - text.count(" ")
        whole[element] += size
        if link:
            linked[element] += size
        else:
            own[element] += size
    score = own[:]
    for e in range(count - 1, 0, -1):  # children come after their parents
        p = o.parents[e]
        whole[p] += whole[e]
        score[p] += 0.5 * own[e]
    best, most = 0, 0.0
    for e in range(1, count):
        density = linked[e] / (own[e] + linked[e]) if own[e] + linked[e] else 0.0
        weight = {"article": 1.5, "main": 1.25, "body": 0.8}.get(o.tags[e], 1.0)
        if (s := score[e] * (1 - density) * weight) > most:
            best, most = e, s
    wide, e = best, best
    while e > 0:  # widen to the article around it, else to the main part
        if o.tags[e] == "article" or o.tags[e] == "main" and o.tags[wide] != "article":
            wide = e
        e = o.parents[e]
    if o.tags[wide] not in ("article", "main"):
        while (p := o.parents[wide]) > 0 and o.tags[p] != "body" \
                and whole[p] <= 1.3 * whole[wide]:
            wide = p
    return wide, most


def text_below(o: Outline, roots: set[int]) -> str:
    inside = [e in roots for e in range(len(o.tags))]
    for e in range(1, len(o.tags)):
        inside[e] |= inside[o.parents[e]]
    raw = "".join([t if inside[e] else " " for e, t, _ in o.pieces])
    return " ".join(entities.unescape(raw).split())


def extract(page: str, path: str | None) -> str:
    """The article's text by the host's path if the page has it, else by its own container."""
    o = outline(page)
    if path is not None:
        roots = o.on_path(path)
        if roots and (text := text_below(o, roots)):
            return text
    return text_below(o, {best_container(o)[0]})


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, scores = [], []
        for page in batch.column("html").to_pylist():
            o = outline(page or "")
            e, score = best_container(o)
            paths.append(o.path(e) if e else None)
            scores.append(score)
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array(paths, pa.string()), pa.array(scores, pa.float64())],
            names=["host", "path", "score"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(page or "", path) for page, path in zip(
            batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes): the path that most pages of a host vote for."""
    votes = pages.select("host", "html").mapInArrow(_vote, "host string, path string, score double")
    counted = votes.filter("path is not null").groupBy("host", "path").agg(
        F.count("*").alias("votes"), F.sum(F.floor("score").cast("long")).alias("score"))
    best = counted.groupBy("host").agg(F.max(F.struct("votes", "score", "path")).alias("b"))
    return best.select("host", "b.path", "b.votes")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars; one row a page."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1))
    rows = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"),
                        host.alias("host"))
    winners = materialise(host_paths(rows), "host-paths").select(
        F.col("host").alias("__host"), "path")
    joined = rows.join(winners, F.col("host") == F.col("__host"), "left")
    return joined.select("page_id", "url", "html", "path").mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint")
