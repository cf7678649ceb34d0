"""Main text of web pages, by paths that the pages of a host agree on.

1. Every page's containers are scored by their share of the page's text, their depth and their name. Scores
   are summed per host and generalised tag-class path: within a batch first, then in Spark.
2. The path with the highest sum wins its host. There is one row per host; Spark joins it to the
   pages by its size, and splits a host with very many pages.
3. Pages are read again and give the text below the winning path. A page without that path, or of another template
   where it holds little, gives the text below its own best container.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored

# What HTML says of its elements, and names that sites give to what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article body center div main section td".split())
NOISE_TAGS = frozenset("nav header footer aside form menu dialog button head label fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOISE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|widget|ads?|advert\w*|banner|"
    r"sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|"
    r"social|related|recommend\w*|comments?|commentlist|disqus|respond|reply|replies|form|search|toolbar|pagination|pager)(?:$|[\s_-])", re.I)
HEAD_NAMES = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-])", re.I)
# A name that says what an element has or lacks says nothing of what it is.
HAS_NAMES = re.compile(r"(?:^|[\s_-])(?:has|no|with|without)[_-]\S*", re.I)
# What follows an article and may be longer than it.
THREAD_NAMES = re.compile(
    r"(?:^|[\s_-])(?:related|recommend\w*|comments?|commentlist|disqus|respond|reply|replies)(?:$|[\s_-])", re.I)
GOOD_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|entry|post|story|text|main)(?:$|[\s_-])", re.I)
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
ARTICLE_BLOCKS = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote".split())
LISTS = frozenset("ul ol dl table menu dir".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*/>"
    r"|<(?P<raw>script|style|noscript|template|textarea|select|svg|math|iframe|object|video|audio|canvas|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?/][^>]*>"
    r"|<[a-zA-Z][^<>]*>"
    r"|<[a-zA-Z/!?][^>]*\Z", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
DEEPEST = 64


def attributes_of(source: str) -> dict[str, str]:
    """The attributes of a tag; of a name that stands twice the first, as browsers take it."""
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), a or b or c)
    return found


def unseen(attributes: dict[str, str]) -> bool:
    """Whether an element is not shown."""
    return (attributes.get("hidden", "until-found").lower() != "until-found" or attributes.get("aria-hidden", "").strip().lower() == "true"
            or bool(UNSEEN.search(attributes.get("style", ""))))


class Page(NamedTuple):
    """Elements in order (parent, name, path, depth, good name) and blocks (element, text).

    suspects: elements that may be noise by what they are called, and as what: ``thread`` follows articles, ``head`` stands over
    them, ``form`` may wrap the page, ``name`` is any other. noisy: articles and the like with such names.
    """

    parents: list[int]
    names: list[str]
    paths: list[str]
    depths: list[int]
    good: list[bool]
    suspects: dict[int, str]
    noisy: set[int]
    blocks: list[tuple[int, str]]


def _without_noise(page: Page) -> Page:
    """The page without the blocks below elements that their names make noise.

    Names are judged when the text below them is known, the longest first. An element stays where it holds
    more than all other text not muted, unless the article stands elsewhere: an article, a main or a well named
    element outside it and none in it, or, for what follows articles, a heading or paragraph outside it and no h1 in
    it. It also stays where it holds the page's articles or main. A form is judged like this too, and never stays within an article or where
    most headings and paragraphs are outside it. A header within an article stays if it holds the page's first heading of the highest rank.
    """
    if not page.suspects:
        return page
    n = len(page.parents)
    owner, last = [0] * n, list(range(n))  # the nearest suspect, and the last element below
    held, own, proper, in_article, in_named = [0] * n, [0] * n, [0] * n, [False] * n, [False] * n
    for i in range(1, n):
        up = page.parents[i]
        owner[i] = i if i in page.suspects else owner[up]
        in_article[i] = in_article[up] or page.names[up] == "article"
        in_named[i] = in_named[up] or page.good[up] and up not in page.suspects
    for element, block in page.blocks:
        held[element] += len(block)
        own[owner[element]] += len(block)
        proper[element] += len(block) if page.names[element] in ARTICLE_BLOCKS else 0
    for i in range(n - 1, 0, -1):
        up = page.parents[i]
        held[up] += held[i]
        proper[up] += proper[i]
        last[up] = max(last[up], last[i])
    named = [i for i in range(1, n) if page.good[i] and held[i] and i not in page.suspects and i not in page.noisy]
    heads = [i for i in range(1, n) if page.names[i] == "h1" and held[i]]
    ranks = [(page.names[i], i) for i in range(1, n) if page.names[i] in HEADINGS and held[i]]
    title = min(ranks, default=("", n))[1]
    articles = [i for i in named if page.names[i] in ("article", "main")]
    first_end = {id(found): min((last[k] for k in found), default=n) for found in (named, articles)}
    kept, unmuted = {0}, own[0]

    def holds(i: int, found: list[int]) -> bool:
        return bisect_right(found, last[i]) > bisect_right(found, i)

    def elsewhere(i: int, found: list[int]) -> bool:
        return bool(found) and (found[-1] > last[i] or first_end[id(found)] < i)

    def stands(i: int) -> bool:
        if holds(i, articles) and not in_article[i] and not elsewhere(i, articles):
            return True
        if page.suspects[i] == "head" and in_article[i]:
            return i < title <= last[i]
        if page.suspects[i] == "form" and (in_named[i] or proper[i] * 2 < proper[0]):
            return False
        if held[i] <= unmuted or page.suspects[i] == "thread" and proper[0] > proper[i] and not holds(i, heads):
            return False
        return holds(i, named) or not elsewhere(i, named)

    for i in sorted(page.suspects, key=lambda k: (-held[k], k)):
        if held[i] and owner[page.parents[i]] in kept and stands(i):
            kept.add(i)
            unmuted += own[i]
    return page._replace(blocks=[b for b in page.blocks if owner[b[0]] in kept])


def parse(source: str) -> Page:
    page = Page([-1], ["html"], [""], [0], [False], {}, set(), [])
    stack: list[tuple[str, int, bool, bool]] = [("html", 0, False, False)]
    muted, articles, text, at = 0, 0, [], 0

    def flush():
        if text:
            block = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if block:
                page.blocks.append((stack[-1][1], block))

    def close(n):
        nonlocal muted, articles
        flush()
        while len(stack) > n:
            closed = stack.pop()
            muted -= closed[3]
            articles -= closed[0] == "article"

    for m in TOKEN.finditer(source):
        if m.start() > at and not muted:
            text.append(source[at:m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if m["end"]:
            for n in range(len(stack) - 1, 0, -1):
                if stack[n][0] == name:
                    close(n)
                    break
                if stack[n][0] in LISTS and name in CLOSED_BY:
                    break
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br" and not muted:
                text.append(" ")
            continue
        attributes = m["attributes"]
        given = attributes_of(attributes) if attributes and not attributes.isspace() else {}
        names = " ".join(filter(None, (given.get(k) for k in ("class", "id", "role"))))
        big = name in ("body", "main", "article", "html")
        # A form may wrap the whole page, and a header within an article may hold its title.
        wraps = name == "form" or name == "header" and articles > 0
        mute = name in NOISE_TAGS and not wraps or bool(given) and not big and unseen(given)
        plain = HAS_NAMES.sub(" ", names) if names else ""
        noisy = not mute and (wraps or bool(plain) and bool(NOISE_NAMES.search(plain)))
        suspect = noisy and not big
        noise = mute or suspect
        if name not in BLOCKS and not noise:
            continue
        if name == "html":
            continue
        if name in BLOCKS:
            flush()
            if stack[-1][0] == "head" and name != "head" or name == "body" and any(s[0] == "head" for s in stack):
                close(next(n for n, s in enumerate(stack) if s[0] == "head"))
            # Tags that an author may leave out: a block ends a paragraph, an item ends the item before.
            for n in range(len(stack) - 1, 0, -1):
                open_name = stack[n][0]
                if open_name == "p" or open_name in CLOSED_BY.get(name, ()):
                    close(n)
                    if open_name == "p" and name not in CLOSED_BY:
                        break
                elif open_name in LISTS or open_name in CONTAINERS or stack[n][2]:
                    break
        parent = stack[-1][1]
        index = parent
        if suspect and not muted or page.depths[parent] < DEEPEST and not muted and not noise:
            mark = ".".join([name, *sorted({re.sub(r"\d+", "#", c) for c in given.get("class", "").lower().split()})])
            index = len(page.parents)
            page.parents.append(parent)
            page.names.append(name)
            deeper = page.depths[parent] < DEEPEST
            page.paths.append(f"{page.paths[parent]}>{mark}" if deeper else page.paths[parent])
            page.depths.append(page.depths[parent] + deeper)
            if suspect:
                head = name == "header" or HEAD_NAMES.search(plain)
                page.suspects[index] = "thread" if THREAD_NAMES.search(plain) else "head" if head else "form" if name == "form" else "name"
            elif noisy:
                page.noisy.add(index)
            page.good.append(name in ("article", "main") or bool(names) and bool(GOOD_NAMES.search(names)))
        stack.append((name, index, noise, mute))
        if noise:
            flush()
        muted += mute
        articles += name == "article"
    if at < len(source) and not muted:
        text.append(source[at:])
    close(1)
    return _without_noise(page)


def _held(page: Page) -> list[int]:
    """The text below every element, in characters."""
    held = [0] * len(page.parents)
    for element, block in page.blocks:
        held[element] += len(block)
    for i in range(len(held) - 1, 0, -1):
        held[page.parents[i]] += held[i]
    return held


def scores(page: Page) -> dict[str, float]:
    """For each path of a container that holds half of the page's text or more, its best score.

    A container within another such one is left out where headings or paragraphs of the outer one stand outside it.
    The body, which holds other things than the article, counts for this only with what stands in no container.
    """
    n = len(page.parents)
    held, proper, direct, box, over, cut = _held(page), [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
    for i in range(1, n):
        box[i] = i if page.names[i] in CONTAINERS else box[page.parents[i]]
    for element, block in page.blocks:
        if page.names[element] in ARTICLE_BLOCKS:
            proper[element] += len(block)
            direct[box[element]] += len(block)
    for i in range(n - 1, 0, -1):
        proper[page.parents[i]] += proper[i]
    found: dict[str, float] = {}
    for i in range(1, n):
        up = page.parents[i]
        over[i] = over[up]
        if page.names[i] in CONTAINERS and held[i] * 2 >= held[0] > 0:
            j = over[i]
            over[i] = i
            cut[i] = cut[j] or (direct[j] > 0 if page.names[j] in ("html", "body") else proper[j] > proper[i])
            if cut[i]:
                continue
            # The body is what is left to take where nothing narrower is agreed on.
            depth = 0.5 if page.names[i] == "body" else 1 + 0.1 * min(page.depths[i], 10)
            score = held[i] / held[0] * depth + 0.5 * page.good[i]
            found[page.paths[i]] = max(score, found.get(page.paths[i], 0.0))
    return found


def best_of(own: dict[str, float]) -> str:
    return max(own, key=lambda p: (own[p], p)) if own else ""


def passed_over(page: Page, best: str) -> set[str]:
    """Paths of the containers with text that stand neither in the best one nor around it."""
    held = _held(page)
    paths = {page.paths[i] for i in range(1, len(held)) if held[i] and page.names[i] in CONTAINERS}
    return {p for p in paths if p != best and not p.startswith(best + ">") and not best.startswith(p + ">")} if best else set()


def extract(page: Page, path: str | None, passed: list[str] | None = None) -> str:
    """The blocks below elements of this path, else below the page's best container, else all.

    The page's best container also counts where the path leaves out headings or paragraphs around it, or
    holds less than half of the page's text; the latter not if its path is one that the host passes over.
    """
    own = scores(page)
    best = best_of(own)
    if path is None or path not in page.paths:
        path = best
    elif path not in own:
        held = _held(page)
        parts = [held[i] for i in range(len(held)) if page.paths[i] == path and (i == 0 or page.paths[page.parents[i]] != path)]
        if sum(parts) * 2 < held[0]:
            path = path if best in (passed or ()) else best
        elif max(parts) * 2 >= held[0]:
            path = best
    inside = [False] * len(page.parents)
    for i in range(len(inside)):
        inside[i] = page.paths[i] == path or page.parents[i] >= 0 and inside[page.parents[i]]
    return "\n\n".join(block for element, block in page.blocks if inside[element])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0, 0])
        for host, source in zip(*(c.to_pylist() for c in batch.columns)):
            if source:
                page = parse(source)
                own = scores(page)
                best = best_of(own)
                for path, score in own.items():
                    # Whole numbers, so that sums do not depend on their order.
                    total[host, path][0] += round(score * 1000)
                    total[host, path][1] += path == best
                for path in passed_over(page, best):
                    total[host, path][2] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()),
             *(pa.array([v[i] for v in total.values()], pa.int64()) for i in range(3))],
            names=["host", "path", "votes", "best", "passed"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))
        out = [extract(parse(source), path, passed) if source else "" for source, path, passed in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), batch.column(3)],
                                         names=["page_id", "url", "text", "path"])


def host_of(url):
    """The host of an absolute URL in lower case; empty for anything else."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, passed: the container path with the highest sum of scores, the last by name of equals. Hosts without text have none.

    passed: paths that are the best ones of some pages, but stand beside the best one on more pages. Pages whose
    URLs name no host have nothing to agree on.
    """
    votes = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("host <> ''").mapInArrow(
        _votes, "host string, path string, votes long, best long, passed long")
    sums = votes.groupBy("host", "path").agg(*(F.sum(c).alias(c) for c in ("votes", "best", "passed")))
    return sums.where("votes > 0").groupBy("host").agg(
        F.max_by("path", F.struct("votes", "path")).alias("path"),
        F.sort_array(F.collect_list(F.when((F.col("best") > 0) & (F.col("passed") > F.col("best")), F.col("path")))).alias("passed"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, path: one row for each input row.

    A null or empty page, or one without text, gives an empty text. Null and relative URLs name no host; their
    pages give their own best containers, and path is null. Repeated rows give equal rows (and vote once each). Other columns are not read. An
    empty table gives no rows.
    """
    winners = stored(host_paths(pages, url_col, html_col), "host-paths").withColumnRenamed("host", "__host")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host_of(F.col(url_col)).alias("__own"))
    joined = rows.join(winners, F.col("__own") == F.col("__host"), "left").select("page_id", "url", "html", "path", "passed")
    kind = dict(rows.dtypes)["page_id"]
    return joined.mapInArrow(_texts, f"page_id {kind}, url string, text string, path string")
