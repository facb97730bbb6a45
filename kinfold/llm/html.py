"""Main text of web pages by minimum-cut labelling.

A page becomes a row of blocks (text between block-level marks). A logistic classifier on the
form of a block gives the costs of calling it content or boilerplate; they are the capacities
to the two terminals. What the page's marks say is added: a block in a part marked as a menu,
footer, form, advert or comment leans to boilerplate, a block inside an article to content. Each mark is
worth little more than a sure classifier, so classifier and neighbours together overrule it. A mark around most of the page's
text, or around its main article and half of the text, says how the page is laid out and counts for less or nothing. Edges
between neighbours, and between the blocks of one parent, cost more the nearer the blocks are
in the tree. The minimum cut, found as a maximum flow, is the labelling with the least cost.

The classifier is fitted on a bounded sample of pages (``sample_pages``), whose blocks are labelled by
their marks; on pages without such marks it decides together with the neighbourhood.

Defined cases: a null or empty page gives an empty text; unclosed and stray tags are taken as
browsers take them, but an object, canvas, frame or the like without its end tag hides nothing; an empty table gives an empty result; repeated rows are answered alike; null ids and urls are
kept; extra columns are ignored. A block whose two labels cost the same is boilerplate.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.registry import query, table
from kinfold.llm.text import within

# Elements by their part in a page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol option p pre section select summary table "
    "tbody td textarea tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title".split())
#: What stands in for something else: not read, unless the end tag is missing; then the page goes on.
FALLBACK_TAGS = frozenset("noscript template iframe object canvas svg math".split())
#: Elements that keep a start tag below them from closing one above them.
BARRIERS = frozenset("table ul ol dl noscript template iframe object foreignobject desc annotation-xml".split())
#: Parts of a drawing that hold HTML.
DRAWN_HTML = frozenset("foreignobject desc title annotation-xml".split())
BREAKOUT_TAGS = BLOCK_TAGS - {"title"} | frozenset("b big code em embed i img meta nobr ruby s small span strong strike sub sup tt u var".split())
NEVER_TAGS = frozenset("nav footer aside form head button select dialog menu fieldset".split())
NEVER_NAMES = frozenset(
    "nav navbar navigation menu menubar header masthead footer sidebar aside ad ads adv advert adverts advertisement adsense banner promo "
    "promotion sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login social share sharing related recommended breadcrumb breadcrumbs comment comments "
    "disqus respond reply replies widget search toolbar pagination pager copyright legal".split()
)
LIKELY_NAMES = frozenset("article content post entry story main maincontent text".split())
CLOSED_BY = {
    "p": BLOCK_TAGS - {"br", "body", "html", "head"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "head": {"body"},
}
#: The open elements that a start tag closes.
CLOSED_AT = {t: [k for k, by in CLOSED_BY.items() if t in by] for t in frozenset().union(*CLOSED_BY.values())}
SHAPE_TAGS = {"p": 0, "h1": 1, "h2": 1, "h3": 1, "h4": 1, "li": 2, "td": 3, "div": 4}

#: For the distance of blocks, elements deeper than this are siblings, as browsers make them; all else of them counts.
DEPTH = 512

TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|$))|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)", re.S)
BLANK = re.compile(r"[\s/]*")
NAME = re.compile(r"=?[^\s/>=]*")
EQUALS = re.compile(r"\s*=\s*")
BARE = re.compile(r"[^\s>]*")
UNSHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
BESIDE = re.compile(r"(?:has|with|no|without)(?:[-_]|(?=[A-Z]))")  # names of what lies below or beside
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Block:
    text: str
    tag: str
    marked: float  # 0 to 1: lies in a part marked as no content
    inside: bool
    likely: bool
    linked: int  # characters inside links
    place: tuple  # (number, place of the parent) of the innermost open element


@dataclass
class HtmlParams:
    sample_pages: int = 1500
    sample_chars: int = 1 << 16  # longer pages are not fitted on; they are extracted whole like any other
    lean: float = 3.0  # of blocks inside an article
    likely: float = 3.0
    mark: float = 7.0  # of blocks in parts marked as no content, the other way
    smooth: float = 3.0
    clip: float = 5.0
    weights: list[float] = field(default_factory=list)


def attributes_at(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """Attributes of a tag from behind its name on: (first value by lower-case name, whether it closes itself, place behind the tag).

    Quotes count only where a value begins; elsewhere they are part of a name or of a bare value, which ends at a blank or
    the end of the tag. A quoted value without its second quote ends at the end of the tag.
    """
    out: dict[str, str] = {}
    size = len(page)
    while True:
        begin, at = at, BLANK.match(page, at).end()
        if at >= size:
            return out, False, size
        if page[at] == ">":
            return out, at > begin and page[at - 1] == "/", at + 1
        m = NAME.match(page, at)
        name, at = m[0].lower(), m.end()
        value, m = "", EQUALS.match(page, at)
        if m is not None:
            at = m.end()
            quote = page[at : at + 1]
            if quote in ("'", '"'):
                end = page.find(quote, at + 1)
                if end < 0:
                    end = page.find(">", at)
                    end = size if end < 0 else end
                    value, at = page[at + 1 : end], end
                else:
                    value, at = page[at + 1 : end], end + 1
            else:
                m = BARE.match(page, at)
                value, at = m[0], m.end()
        out.setdefault(name, value)


def _hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true"
        or ("style" in attributes and UNSHOWN.search(attributes["style"]) is not None)
    )


def _named(attributes: dict[str, str], tag: str, inside: bool) -> tuple[bool, bool]:
    """(never content, likely content) by class, id and role."""
    never = likely = False
    for key in ("class", "id", "role"):
        value = attributes.get(key)
        if not value:
            continue
        if tag == "article":
            never |= any(c in ("comment", "reply", "ad", "advert") for c in value.lower().split())
            continue
        names = {p.lower() for c in value.split() if not BESIDE.match(c) for p in PARTS.findall(c)}
        if inside:
            names.discard("header")
        never |= bool(names & NEVER_NAMES)
        likely |= bool(names & LIKELY_NAMES)
    return never, likely


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order."""
    out: list[Block] = []
    # Open elements: (tag, place, innermost mark, innermost article, likely, in a link, innermost fallback element).
    stack: list[tuple[str, tuple, int, int, bool, bool, int]] = [("", (0, None), 0, 0, False, False, 0)]
    marks: dict[int, int] = {}  # the next marked element around a marked element
    articles: dict[int, tuple[int, int]] = {}  # the next article around an article, and the innermost mark
    above: dict[int, int] = {}  # the next fallback element around a fallback element
    shut: set[int] = set()  # fallback elements that met their end tag
    open_at: dict[str, list[int]] = {}  # stack places of the open elements of a tag
    pieces: list[tuple[str, bool, int]] = []
    number = 0
    drafts: list[tuple[list, str, tuple]] = []

    def close_block() -> None:
        nonlocal pieces
        if pieces:
            tag = next((s[0] for s in reversed(stack) if s[0] in BLOCK_TAGS), "")
            drafts.append((pieces, tag, stack[-1]))
            pieces = []

    def say(text: str) -> None:
        if text:
            pieces.append((text, stack[-1][5], stack[-1][6]))

    def push(element: tuple) -> None:
        open_at.setdefault(element[0], []).append(len(stack))
        stack.append(element)

    def pop(k: int) -> None:
        for s in stack[k:]:
            open_at[s[0]].pop()
        del stack[k:]

    def innermost(tags) -> int:
        """Stack place of the innermost open element of some tags, 0 if there is none."""
        return max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)

    def drawn_now() -> bool:
        """Whether what is read now belongs to a drawing and not to HTML inside one."""
        k = innermost(("svg", "math"))
        return k > 0 and k > innermost(DRAWN_HTML)

    at, size = 0, len(page)
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            say(page[at:])
            break
        m = TAG.match(page, begin)
        if m is None:  # a lone sign
            say(page[at : begin + 1])
            at = begin + 1
            continue
        say(page[at:begin])
        at = m.end()
        if m[2] is None:
            if page.startswith("<![CDATA[", begin) and drawn_now():  # elsewhere it is a comment that ends at the first ">"
                end = page.find("]]>", begin)
                at = size if end < 0 else end + 3
            continue
        tag = m[2].lower()
        attributes, closed, at = attributes_at(page, at)
        drawn = drawn_now()
        if drawn and not m[1] and tag in BREAKOUT_TAGS:  # browsers leave the drawing at such a tag
            pop(min(open_at[t][0] for t in ("svg", "math") if open_at.get(t)))
            drawn = False
        if m[1]:
            if tag in BLOCK_TAGS and not (tag == "title" and innermost(("svg", "math"))):
                close_block()
            if open_at.get(tag):
                k = open_at[tag][-1]
                if tag in FALLBACK_TAGS and stack[k][6] != stack[k - 1][6]:
                    shut.add(stack[k][6])
                pop(k)
            continue
        if drawn:
            if not closed:
                number += 1
                push((tag, *stack[-1][1:]))
            continue
        if tag in BLOCK_TAGS:
            close_block()
        if tag in VOID_TAGS:
            continue
        if tag in RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(page, at)
            at = size if end is None else end.end()
            continue
        k = innermost(CLOSED_AT.get(tag, ()))
        if k and innermost(BARRIERS) <= k:
            pop(k)
        number += 1
        _, _, mark, inside, likely, link, fallback = stack[-1]
        unseen = tag in FALLBACK_TAGS
        never = False
        if tag not in ("html", "body", "main"):
            never, named_likely = _named(attributes, tag, inside > 0)
            never |= tag in NEVER_TAGS or (tag == "header" and not inside)
            likely |= named_likely
            if tag == "head" or _hidden(attributes):
                unseen = True
                shut.add(number)
        if never:
            marks[number], mark = mark, number
        if tag in ("article", "main") and not never:
            articles[number], inside = (inside, mark), number
        if not closed or (tag in BLOCK_TAGS and tag not in FALLBACK_TAGS):
            if unseen:
                above[number], fallback = fallback, number
            push((tag, (number, stack[min(len(stack), DEPTH) - 1][1]), mark, inside, likely, link or tag == "a", fallback))
    close_block()
    unread = {0: False}
    for k, outer in above.items():  # outer ones come first
        unread[k] = k in shut or unread[outer]
    inmost: list[tuple[int, int]] = []
    for said, tag, top in drafts:
        said = [x for x in said if not unread[x[2]]]
        text = " ".join(html.unescape("".join(x[0] for x in said)).split())
        if text:
            inmost.append((top[2], top[3]))
            out.append(Block(text, tag, 0.0, top[3] > 0, top[4], sum(len(x[0]) for x in said if x[1]), top[1]))
    part = _marked(out, inmost, marks, articles)
    for b, (mark, _) in zip(out, inmost, strict=True):
        b.marked = part[mark]
    return out


def _marked(blocks: list[Block], inmost: list[tuple[int, int]], marks: dict[int, int], articles: dict[int, tuple[int, int]]) -> dict[int, float]:
    """How far each marked element is no content, from 0 to 1, with the marks around it."""
    under, of_article, total = dict.fromkeys([0, *marks], 0), dict.fromkeys([0, *articles], 0), 0
    for b, (mark, article) in zip(blocks, inmost, strict=True):
        own = max(0, len(b.text) - b.linked)
        total += own
        under[mark] += own
        of_article[article] += own
    for k in sorted(marks, reverse=True):  # inner ones come first
        under[marks[k]] += under[k]
    for k in sorted(articles, reverse=True):
        of_article[articles[k][0]] += of_article[k]
    # Marks around the largest article.
    around: set[int] = set()
    if articles:
        mark = articles[max(articles, key=lambda k: (of_article[k], -k))][1]
        while mark:
            around.add(mark)
            mark = marks[mark]
    part = {0: 0.0}
    for k in sorted(marks):
        share = under[k] / total if total else 0.0
        own = max(0.0, 1 - 2 * share) if k in around else 1.0 if articles else 1 - share
        part[k] = max(own, part[marks[k]])
    return part


def shape(blocks: list[Block]) -> np.ndarray:
    """Features of the form of each block; marks that name a part of the page are left out."""
    out = np.zeros((len(blocks), 13))
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        stops = b.text.count(".") + b.text.count("!") + b.text.count("?")
        out[i, :6] = (
            math.log1p(words), min(1.0, b.linked / len(b.text)), min(1.0, stops / words * 5), b.text[-1] in ".!?",
            i / max(1, len(blocks) - 1), b.text.count(",") / words,
        )
        out[i, 6 + SHAPE_TAGS.get(b.tag, 5)] = 1
    out[:, 12] = 1
    return out


def cut(content: list[float], boilerplate: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Content side of the minimum cut; the capacities are the costs of the *other* label.

    Dinic's algorithm: levels from the content terminal, then blocking flows along them. Direct paths
    over one block are taken off first, so that a block keeps capacity to one terminal only.
    """
    n = len(content)
    source = [max(0.0, c - b) for c, b in zip(content, boilerplate, strict=True)]
    sink = [max(0.0, b - c) for c, b in zip(content, boilerplate, strict=True)]
    to: list[int] = []
    room: list[float] = []
    links: list[list[int]] = [[] for _ in range(n)]
    for (a, b), w in edges.items():
        links[a].append(len(to))
        to.append(b)
        room.append(w)
        links[b].append(len(to))
        to.append(a)
        room.append(w)
    tiny = 1e-12
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if source[i] > tiny)
        for i in queue:
            level[i] = 0
        ends = False
        while queue:
            v = queue.popleft()
            ends |= sink[v] > tiny
            for e in links[v]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if not ends:
            return [x >= 0 for x in level]
        place = [0] * n
        for start in range(n):
            while source[start] > tiny:
                path, v = [], start
                while sink[v] <= tiny:  # walk down the levels, step back from dead ends
                    while place[v] < len(links[v]):
                        e = links[v][place[v]]
                        if room[e] > tiny and level[to[e]] == level[v] + 1:
                            break
                        place[v] += 1
                    if place[v] < len(links[v]):
                        path.append(links[v][place[v]])
                        v = to[path[-1]]
                    elif path:
                        v = to[path.pop() ^ 1]
                        place[v] += 1
                    else:
                        v = -1
                        break
                if v < 0:
                    break
                flow = min([source[start], sink[v], *(room[e] for e in path)])
                source[start] -= flow
                sink[v] -= flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def labelled(blocks: list[Block], p: HtmlParams) -> list[bool]:
    """True for content."""
    x = shape(blocks)
    lean = np.clip(x @ np.array(p.weights), -p.clip, p.clip) if p.weights else np.zeros(len(blocks))
    content, boilerplate = [], []
    for b, score in zip(blocks, lean.tolist(), strict=True):
        score += (1 - b.marked) * (p.lean * b.inside + p.likely * b.likely) - p.mark * b.marked
        content.append(_softplus(score))  # the cost of calling it boilerplate
        boilerplate.append(_softplus(-score))
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        before = {i - 1} if i else set()
        parent = b.place[1][0] if b.place[1] else 0
        if parent in last:
            before.add(last[parent])
        last[parent] = i
        for j in before:
            edges[j, i] = p.smooth * math.exp(-_apart(blocks[j].place, b.place) / 3)
    return cut(content, boilerplate, edges)


def _softplus(x: float) -> float:
    return x + math.log1p(math.exp(-x)) if x > 0 else math.log1p(math.exp(x))


def _apart(a: tuple, b: tuple) -> int:
    """Steps between two places of the tree; a parent's number is smaller than its child's."""
    steps = 0
    while a[0] != b[0] and steps < 2 * DEPTH:
        if a[0] > b[0]:
            a = a[1]
        else:
            b = b[1]
        steps += 1
    return steps


def main_text(page: str | None, p: HtmlParams) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return "\n".join(b.text for b, keep in zip(blocks, labelled(blocks, p), strict=True) if keep)


def train(pages: DataFrame, p: HtmlParams) -> list[float]:
    """Weights of the logistic classifier, by Newton steps on the sums that tasks return."""
    # Only hashes are ordered; the pages up to the last chosen hash are then read where they lie.
    hashed = pages.filter(F.length("html") <= p.sample_chars).select("html", F.xxhash64("page_id", "html").alias("h"))
    last = hashed.select("h").orderBy("h").limit(p.sample_pages).agg(F.max("h")).first()[0]
    sample = hashed.filter(F.col("h") <= F.lit(last)).select("html") if last is not None else hashed.select("html").limit(0)

    def run(batches):
        for b in batches:
            for page in b.column(0).to_pylist():
                blocks = blocks_of(page)
                known = [k for k in blocks if k.marked > 0.5 or k.inside]
                if known:
                    y = pa.array([0 if k.marked > 0.5 else 1 for k in known])
                    yield pa.RecordBatch.from_arrays([pa.array(shape(known).tolist(), pa.list_(pa.float64())), y], names=["x", "y"])

    rows = within(sample, run, "x array<double>, y long").groupBy("x", "y").count().toPandas()
    if rows["y"].nunique() < 2:
        return []
    x, y, n = np.array(rows["x"].tolist()), rows["y"].to_numpy(float), rows["count"].to_numpy(float)
    order = np.lexsort(x.T)
    x, y, n = x[order], y[order], n[order]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - q)) - w
        bend = (x * (n * q * (1 - q))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def extracted(pages: DataFrame, p: HtmlParams) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches):
        for b in batches:
            texts = [main_text(t, p) for t in b.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    return within(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")


@query("op3_html_extraction")
def op3_html_extraction(spark, folder):
    pages = table(spark, folder, "pages")
    p = HtmlParams()
    p.weights = train(pages, p)
    return extracted(pages, p)
