"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks (text between block-level tags).  A linear classifier over each
block's place in the page and its text gives the cost of calling it content or
boilerplate; these costs are the capacities from the source and to the sink.  Smoothness edges
between blocks that follow each other, and between blocks of one parent element,
make unlike labels cost something.  The minimum cut, found by maximum flow, is the labelling
of least total cost.  Elements that never show as article text (menus, scripts, controls, ...)
have an infinite cost of being content, and so have elements whose name or role says that they
are not the article, unless they hold it: an element around (nearly) all text that is left, or
around an article and most of that text, is only a wrapper.
"""

from __future__ import annotations

import html
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm import common
from scanloom.llm.common import text_of

#: Fixed values of HTML: elements whose text is not markup, elements without an end tag, and inline elements.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "annotation", "annotation-xml"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math semantics annotation annotation-xml mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mspace mstyle mpadded mphantom mtable mtr mtd".split())
#: Start tags that end an open element of these names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre search section summary table ul".split())
#: Elements that are never article text, roles, and words of class or id that say the same.
NEVER = set("head script style noscript template iframe object embed svg canvas audio video map nav footer aside button select textarea input menu search title noembed noframes xmp datalist".split())
WRAPS = {"form", "dialog"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "tablist"}
STRONG = set("ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar side comment comments commentlist disqus reply replies respond discussion breadcrumb breadcrumbs pagination pager menu navbar nav navigation footer masthead topbar toolbar share sharing social related recommended recommendations widget skip".split())
GOOD = set("article content post entry story body main text".split())
#: Words that turn a name into a statement about the page, such as has-sidebar or comments-open.
ABOUT = {"has", "with", "without", "no", "open", "closed", "enabled", "disabled", "on", "off"}
#: Names of readers' comments: such an element is a wrapper only if nothing is left outside it.
COMMENTS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "discussion"}
#: Share of the text left of an element that is only a wrapper, and if it has an article in it.
NEARLY, MOST = 0.95, 0.5
HARD = 1e9
#: Weights of the classifier, and of unlike labels of neighbours and of blocks of one parent.
W = {"bias": -0.8, "article": 3.0, "main": 2.0, "good_name": 2.0, "heading": 0.5, "paragraph": 1.0, "list": 0.2, "words": 0.08, "most_words": 2.4, "stop": 0.6, "links": -4.0, "header": -2.5}
NEXT, SIBLING = 0.6, 0.4

_TAG = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAMES = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(text)}


class Block:
    __slots__ = ("parts", "links", "hard", "article", "main", "good", "header", "tag", "parent", "marks")

    def __init__(self, frame):
        self.parts, self.links = [], 0
        self.hard, self.article, self.main, self.good, self.header, self.tag, self.parent, self.marks = frame[1:9]


def _release(found: list[tuple[str, Block]], comments: set[int]) -> None:
    """Make the blocks hard that are in a marked element which is not only a wrapper.

    Marked elements are a tree, looked at from the inside (a later number is never around
    an earlier one).  What an element holds is its text that is not hard, what is left outside
    is the text directly in the marked elements around it or in none."""
    held: dict[int, int] = {-1: 0}
    article: dict[int, bool] = {}
    around: dict[int, tuple] = {}
    for text, b in found:
        for k, m in enumerate(b.marks):
            around.setdefault(m, b.marks[:k])
        if not b.hard:
            m = b.marks[-1] if b.marks else -1
            held[m] = held.get(m, 0) + len(text)
            article[m] = article.get(m, False) or b.article or b.main
    kept = set()
    for m in sorted(around, reverse=True):
        own = held.get(m, 0)
        left = held[-1] + sum(held.get(x, 0) for x in around[m])
        share = own / max(1, own + left)
        if own and (not left or article[m] and share >= MOST or m not in comments and share >= NEARLY):
            up = around[m][-1] if around[m] else -1
            held[up] = held.get(up, 0) + own
            article[up] = article.get(up, False) or article[m]
        else:
            kept.add(m)
    for _, b in found:
        b.hard = b.hard or not kept.isdisjoint(b.marks)


def blocks(page: str) -> list[tuple[str, Block]]:
    """(text, block) of all blocks that have text, in page order.

    A frame of the stack is (element, hard, in article, in main, good name, in header, block
    tag, number of the parent block element, numbers of the marked elements around, block
    that goes on behind an inline element that is set apart)."""
    stack: list[tuple] = [("", False, False, False, False, False, "", 0, (), None)]
    out: list[Block] = []
    comments: set[int] = set()
    state = {"block": None, "n": 0, "links": 0, "marks": 0}

    def put(text: str):
        if not text or stack[-1][1] and text.isspace():
            return
        if state["block"] is None:
            state["block"] = Block(stack[-1])
            out.append(state["block"])
        state["block"].parts.append(text)
        if state["links"]:
            state["block"].links += len("".join(text.split()))

    def close(names, stop=()):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                if any(f[0] not in INLINE for f in stack[k:]):
                    state["block"] = None
                else:
                    state["block"] = next((f[9] for f in stack[k:] if f[9] is not None), state["block"])
                state["links"] -= sum(f[0] == "a" for f in stack[k:])
                del stack[k:]
                return
            if stack[k][0] in stop:
                return

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            put(html.unescape(page[at:]))
            break
        if m.start() > at:
            put(html.unescape(page[at:m.start()]))
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                put(m[0][9:].removesuffix("]]>"))
            continue
        if m[1]:
            if name in ("p",) and not any(f[0] == "p" for f in stack):
                state["block"] = None
            close({name}, () if name in ("html", "body", "article", "main", "div", "section") or name in INLINE else ("td", "th", "article", "main"))
            continue
        if name == "br":
            put("\n")
            continue
        if name in RAW:
            end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            at = size if end is None else end.start()
            if name not in INLINE:
                state["block"] = None
            if end is not None:
                at = page.find(">", at) + 1 or size
            continue
        if name in ENDS_P:
            close({"p"}, ("td", "th", "li", "div", "article", "section", "main", "body", "blockquote", "button"))
        if name in CLOSES:
            close(CLOSES[name], ("ul", "ol", "menu", "dl", "table", "select"))
        if name in VOID:
            if name not in INLINE:
                state["block"] = None
            continue
        a = _attributes(m[3]) if m[3].strip() else {}
        top = stack[-1]
        names = " ".join((a.get("class", ""), a.get("id", ""))).split() if "class" in a or "id" in a else ()
        each = [{w.lower() for w in _NAMES.findall(x)} for x in names]
        words = set().union(*each)
        in_article = top[2] or name == "article" or a.get("itemprop") == "articleBody"
        hidden = "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower()
        hard = top[1] or name in NEVER or hidden
        said = [x & STRONG for x in each if x & STRONG and not x & ABOUT] if name not in ("html", "body", "article", "main") else []
        inline = name in INLINE
        banner = name == "header" or "header" in words and not words & GOOD
        marks = top[8]
        if said or name in WRAPS or a.get("role", "").lower() in ROLES or banner and not in_article:
            marks += (state["marks"],)
            if any(x & COMMENTS for x in said):
                comments.add(state["marks"])
            state["marks"] += 1
        apart = inline and (hard != top[1] or marks != top[8])
        resume = state["block"] if apart else None
        if not inline or apart:
            state["block"] = None
        if not inline:
            state["n"] += 1
        stack.append((name, hard, in_article, top[3] or name == "main" or a.get("role") == "main", top[4] or bool(words & GOOD), top[5] or banner, top[6] if inline else name, top[7] if inline else state["n"], marks, resume))
        if name == "a":
            state["links"] += 1
    found = [(t, b) for t, b in ((" ".join("".join(b.parts).split()), b) for b in out) if t]
    _release(found, comments)
    return found


def costs(found: list[tuple[str, Block]]) -> list[float]:
    """Score of each block: above zero speaks for content, the size is the cost of the
    other label; minus HARD where it cannot be content."""
    soft = [len(t.split()) for t, b in found if not b.hard]
    most = max(soft, default=1)
    out = []
    for text, b in found:
        if b.hard:
            out.append(-HARD)
            continue
        n = len(text.split())
        s = W["bias"] + min(20, n) * W["words"] + W["most_words"] * n / most + W["links"] * b.links / max(1, len(text.replace(" ", "")))
        s += W["article"] * b.article + W["main"] * (b.main and not b.article) + W["good_name"] * b.good
        s += W["heading"] * (b.tag in ("h1", "h2", "h3", "h4", "h5", "h6")) + W["paragraph"] * (b.tag in ("p", "blockquote", "pre")) + W["list"] * (b.tag in ("li", "td", "th"))
        s += W["stop"] * (text[-1] in ".!?…:\"”") + W["header"] * (b.header and b.tag not in ("h1", "h2"))
        out.append(s)
    return out


def min_cut(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source side of a minimum cut: node i costs
    max(0, score) on the sink's side, max(0, -score) on the source's, an edge its weight
    when it is cut.  Of equal cuts, the one with the fewest nodes on the source side."""
    n = len(score)
    sums = [0.0] * n
    for a, b, w in edges:
        sums[a] += w
        sums[b] += w
    label = [s > 0 for s in score]
    # a node whose own cost outweighs all its edges keeps its label in every minimum cut
    loose = [abs(s) <= c for s, c in zip(score, sums)]
    if not any(loose):
        return label
    S, T = n, n + 1
    out: list[list[int]] = [[] for _ in range(n + 2)]
    to, cap = [], []

    def add(a, b, w, back=0.0):
        if w or back:
            out[a].append(len(to))
            out[b].append(len(to) + 1)
            to.extend((b, a))
            cap.extend((w, back))

    pull = [0.0] * n
    for a, b, w in edges:
        if loose[a] and loose[b]:
            add(a, b, w, w)
        elif loose[a]:
            pull[a] += w if label[b] else -w
        elif loose[b]:
            pull[b] += w if label[a] else -w
    for i in range(n):
        if loose[i]:
            add(S, i, max(0.0, score[i] + pull[i]))
            add(i, T, max(0.0, -score[i] - pull[i]))
    eps = 1e-12
    while True:
        level = [-1] * (n + 2)
        level[S] = 0
        queue = deque([S])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[T] < 0:
            return [level[i] >= 0 if loose[i] else label[i] for i in range(n)]
        turn, path, at = [0] * (n + 2), [], S
        while True:
            if at == T:
                room = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= room
                    cap[e ^ 1] += room
                path, at = [], S
            while turn[at] < len(out[at]) and not (cap[out[at][turn[at]]] > eps and level[to[out[at][turn[at]]]] == level[at] + 1):
                turn[at] += 1
            if turn[at] < len(out[at]):
                path.append(out[at][turn[at]])
                at = to[path[-1]]
            elif path:
                at = to[path.pop() ^ 1]
                turn[at] += 1
            else:
                break


def extract(page: str) -> tuple[str, int]:
    """The main text and the number of blocks that were labelled."""
    found = blocks(page)
    if not found:
        return "", 0
    score, edges, last = costs(found), [], {}
    for i, (_, b) in enumerate(found):
        if i:
            edges.append((i - 1, i, NEXT))
        if b.parent in last and last[b.parent] != i - 1:
            edges.append((last[b.parent], i, SIBLING))
        last[b.parent] = i
    keep = min_cut(score, edges)
    return "\n\n".join(t for (t, _), k in zip(found, keep) if k), len(found)


def main_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """page_id, url, text, n_chars, n_blocks: one row per row.

    White space inside a block (a line break of ``<br>`` is white space) is one space, blocks are
    joined by an empty line.  Null and empty pages, and pages without content, have an
    empty text; null ids and urls stay null; rows with equal ids each keep a row; other
    columns are not read; whole pages are read whatever their length."""
    common.small_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"))

    def run(batches):
        for b in batches:
            got = [extract(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([t for t, _ in got], pa.string()), pa.array([len(t) for t, _ in got], pa.int64()), pa.array([n for _, n in got], pa.int32())],
                                             names=["page_id", "url", "text", "n_chars", "n_blocks"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint, n_blocks int")
