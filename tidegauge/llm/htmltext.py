"""Main text of web pages by minimum cut.

A page becomes a row of text blocks. A linear classifier scores each block from its length,
links, punctuation and the names around it; the scores become the capacities of the block's
edges to the terminals content and boilerplate. Neighbours on the page and near relatives in
the element tree are joined by smoothness edges. The minimum cut, found by maximum flow, is
the cheapest labelling; the content blocks in page order are the text.

Names are whole tokens of class, id and role; a word that can mean little else, such as comments or
cookie, also counts as a part of a token. Names, ``form`` and ``hidden`` say nothing against ``html``,
``body`` and ``main``, nor against what is around ``main``, or around the first ``h1`` or the
``article`` of most text if it holds most of the page's text. So comments, adverts or a sidebar longer than
the article stay out.

Nulls and empty pages have the empty text. White space inside a block becomes one space,
blocks are joined by a line feed. Repeated pages have equal texts. An empty table gives an
empty result. Columns ``text`` and ``n_chars`` of the input give way to those of the result. Markup is
read in one pass forward, broken or not; memory grows with the length of a page; nothing is cut off.
"""

import html
import re
from collections import deque

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import ready

# Element names, and words in class, id and role with their scores.
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol p pre section summary table tbody td tfoot th thead title tr ul").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title".split())
# Elements whose content is no text of the page: up to their end tag, or if it is missing, to the
# end of the page (RAW) or not at all.
RAW = frozenset("script style iframe".split())
SKIPPED = RAW | frozenset("noscript template svg math object canvas audio video button select textarea "
                          "datalist".split())
LISTED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"),
          "tr": ("tr",)}  # elements that end others of their kind, inside the next of LISTS
LISTS = ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot")
WHOLE = frozenset("html body main".split())  # nothing but their tags counts against these
TAG_SCORE = {"article": 4.0, "main": 3.0, "header": -4.0, "footer": -8.0, "aside": -8.0,
             "nav": -9.0, "menu": -9.0, "form": -9.0, "dialog": -9.0, "label": -9.0, "legend": -9.0, "address": -1.0, "li": -0.5, "td": -0.5,
             "blockquote": 0.5, "h1": 1.0, "figcaption": -0.5}
NAME_SCORE = {
    **dict.fromkeys("ad ads adv advert adverts advertisement advertising banner sponsor sponsored "
                    "promo promotion promoted".split(), -9.0),
    **dict.fromkeys("nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip "
                    "toolbar".split(), -9.0),
    **dict.fromkeys("comment comments reply replies disqus discussion respond".split(), -9.0),
    **dict.fromkeys("cookie cookies consent gdpr notice popup modal overlay alert newsletter "
                    "subscribe subscription signup login paywall".split(), -9.0),
    **dict.fromkeys("sidebar aside related recommended recommendations share sharing social widget "
                    "widgets tags footer contentinfo copyright legal disclaimer complementary "
                    "search form".split(), -8.0),
    **dict.fromkeys("header masthead topbar".split(), -4.0),
    **dict.fromkeys("article content main story entry post body text".split(), 3.0)}
# Words that count as a part of a token too: related-posts, site-footer, cookie-consent, post-content.
PARTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted navbar navigation "
    "breadcrumb breadcrumbs pagination comment comments reply replies disqus cookie cookies consent gdpr "
    "newsletter sidebar related recommended footer copyright article content story entry post".split())
BIAS, PER_CHAR, PER_STOP, PER_LINK = -1.0, 0.02, 0.6, -6.0
NEIGHBOUR, SIBLING, COUSIN = 0.6, 0.8, 0.3
STRONG, LOWEST, HIGHEST, AGAIN = -8.0, -12.0, 6.0, 2.0

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']++)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
# Tokens that tell the state or layout of a page, such as has-sidebar, no-sidebar and comments-open.
_STATE = re.compile(r"(?:has|have|no|not|with|without|is|show|hide)[-_]|.*[-_](?:open|opened|closed|enabled|"
                    r"disabled|on|off|left|right|none)\Z")
_SPACES = re.compile(r"\s+")
_STOPS = re.compile(r"[.!?;:,…](?:\s|$)")
_FAR_NUMBER = re.compile(r"&#[0-9]{1000,};?")  # beyond any character, and too long for int()
_ENDS = {name: re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE) for name in SKIPPED}


def _attributes(text):
    """Attributes by name, the first of each; one without a value has the empty value."""
    found = {}
    for match in _ATTRIBUTE.finditer(text):
        found.setdefault(match[1].lower(), match[2] or match[3] or match[4] or "")
    return found


def _named_score(attributes):
    """The lowest score of the names in class, id and role, or else the highest."""
    found = []
    for token in " ".join(attributes.get(k, "") for k in ("class", "id", "role")).lower().split():
        if token in NAME_SCORE:
            found.append(NAME_SCORE[token])
        elif not _STATE.match(token):
            found += [NAME_SCORE[word] for word in _PART.findall(token) if word in PARTS]
    if not found:
        return 0.0
    return min(found) if min(found) < 0 else max(found)


def _is_hidden(attributes):
    return ("hidden" in attributes and attributes["hidden"].lower() != "until-found"
            or attributes.get("aria-hidden", "").lower() == "true"
            or bool(_NO_DISPLAY.search(attributes.get("style", ""))))


def tokens(page):
    """(text before, name, is end tag, attributes) of each tag, comments and unseen content left out.

    The name of a skipped element comes once, as None, and that of a comment as the empty string. The end
    of the page has None and no attributes. Every search goes forward, and one that finds nothing is not made again.
    """
    at = start = 0
    tag, endless = _TAG, set()
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            yield page[start:at], "", False, ""
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            if end < 0:
                break
            end += 1
            yield page[start:at], "", False, ""
        else:
            if not page.startswith("/", at + 1) and not page[at + 1:at + 2].isalpha():
                at += 1
                continue
            found = tag.match(page, at)
            if not found and tag is _TAG and page[at + 1:at + 2] != "/":
                tag = _PLAIN_TAG  # a quotation mark without its second, or no more end of a tag
                found = tag.match(page, at)
            if not found:
                if page.find(">", at) < 0:
                    break
                at += 1
                continue
            end, name = found.end(), found[2].lower()
            closed = None
            if name in SKIPPED and not found[1] and not (
                    name in ("svg", "math") and found[3].endswith("/")) and name not in endless:
                closed = _ENDS[name].search(page, end)
                if not closed and name not in RAW:
                    endless.add(name)
            if closed or name in RAW and not found[1]:
                end = closed.end() if closed else len(page)
                yield page[start:at], None if name not in ("script", "style", "template") else "", False, ""
            else:
                yield page[start:at], name, bool(found[1]), found[3]
        at = start = end
    yield page[start:], None, False, None


class Elements:
    """The open elements of a page and, by number, all that were ever open; 0 is the page."""

    def __init__(self):
        self.parent, self.depth, self.name, self.own, self.free = [0], [0], [""], [0.0], [0.0]
        self.unseen, self.held, self.mark = [False], [0], [False]
        self.stack, self.where = [0], {}

    def open(self, name, own, free):
        """``own`` is the element's score, ``free`` that without what names and hiding say against it."""
        top, number = self.stack[-1], len(self.parent)
        self.parent.append(top)
        self.depth.append(self.depth[top] + 1)
        self.name.append(name)
        self.own.append(own)
        self.free.append(free)
        self.unseen.append(self.unseen[top] or name in UNSEEN)
        self.held.append(0)
        self.mark.append(False)
        for kind in (name, "#block") if name in BLOCKS else (name,):
            self.where.setdefault(kind, []).append(len(self.stack))
        self.stack.append(number)

    def last(self, *names):
        """The highest place on the stack of an element of these names, 0 for none."""
        return max((self.where[n][-1] for n in names if self.where.get(n)), default=0)

    def close(self, place):
        """Closes the elements from this place of the stack on."""
        while len(self.stack) > place:
            name = self.name[self.stack.pop()]
            self.where[name].pop()
            if name in BLOCKS:
                self.where["#block"].pop()

    def around(self):
        """For each element the score that it and those around it give to a block.

        From the page inwards scores add up between bounds. A strong score against an element takes away
        what spoke for those around it, and little that is inside can then speak for it.
        """
        held, n = self.held, len(self.parent)
        for i in range(n - 1, 0, -1):
            held[self.parent[i]] += held[i]
        marks = {"main": [], "h1": [], "article": []}
        for i in range(1, n):
            if self.name[i] in marks and not self.unseen[i]:
                marks[self.name[i]].append(i)
        rooms = [(i, False) for i in marks["main"]] + [(i, True) for i in marks["h1"][:1]]
        if marks["article"]:
            rooms.append((max(marks["article"], key=lambda i: held[i]), True))
        for i, most in rooms:
            while i and not (self.mark[i] and not most):
                self.mark[i] = self.mark[i] or not most or 2 * held[i] > held[0]
                i = self.parent[i]
        score, inside, under = [0.0] * n, [False] * n, [False] * n
        for i in range(1, n):
            up, name = self.parent[i], self.name[i]
            w = self.free[i] if self.mark[i] or name in WHOLE else self.own[i]
            if name == "header" and inside[up]:
                w /= 2
            inside[i] = inside[up] or name in ("article", "main")
            under[i] = under[up] or w <= STRONG
            total = min(0.0, score[up]) + w if w <= STRONG else score[up] + (
                min(w, AGAIN / 2) if under[i] else w)
            top = max(score[up], STRONG + AGAIN) if under[i] and w > STRONG else HIGHEST
            score[i] = max(LOWEST, min(top, total))
        return score


def blocks(page):
    """Text blocks of a page and its elements: ([(text, link characters, element)], elements)."""
    tree = Elements()
    found, pieces, linked = [], [], 0
    link = False

    def end():
        nonlocal linked
        raw = "".join(pieces)
        pieces.clear()
        text = _SPACES.sub(" ", html.unescape(_FAR_NUMBER.sub("\ufffd", raw) if "&#" in raw else raw)).strip()
        if text and not tree.unseen[tree.stack[-1]]:
            found.append((text, linked, tree.stack[-1]))
            tree.held[tree.stack[-1]] += len(text)
        linked = 0

    for text, name, is_end, attributes in tokens(page):
        if text:
            pieces.append(text)
            linked += len(text.strip()) if link else 0
        if attributes is None:
            break
        if not name or name == "br":
            if name is None or name == "br":
                pieces.append(" ")
            continue
        if name == "a":
            link = not is_end
        known = {} if is_end or not attributes else _attributes(attributes)
        named = _named_score(known) if known else 0.0
        if name not in BLOCKS and named > STRONG:
            # The end of an inline element that was taken as a block for its name.
            if is_end and tree.last(name) > tree.last("#block"):
                end()
                tree.close(tree.last(name))
            continue
        if name in VOID:
            if name == "hr":
                end()
            continue
        end()
        link = link and name == "a"
        if is_end:
            if tree.last(name):
                tree.close(tree.last(name))
            continue
        if name in LISTED and tree.last(*LISTED[name]) > tree.last(*LISTS):
            tree.close(tree.last(*LISTED[name]))
        # A paragraph ends where another block begins; a head where the body does.
        while (top := tree.name[tree.stack[-1]]) in ("p", "title") or top == "head" and name == "body":
            tree.close(len(tree.stack) - 1)
        if attributes.endswith("/") and name not in BLOCKS:
            continue
        tag, hidden = TAG_SCORE.get(name, 0.0), -9.0 if known and _is_hidden(known) else 0.0
        tree.open(name, tag + named + hidden, (0.0 if name == "form" else tag) + max(0.0, named))
    end()
    return found, tree


def scores(found, tree):
    """Score of each block: positive for content."""
    around = tree.around()
    return [BIAS + PER_CHAR * min(200, len(text)) + PER_STOP * min(3, len(_STOPS.findall(text)))
            + PER_LINK * min(1.0, linked / len(text)) + around[element] for text, linked, element in found]


def edges(found, tree):
    """Smoothness edges (i, j, weight): neighbours on the page, siblings and cousins.

    A block is joined to the block before it, and to the last block before it of the same
    parent and of the same grandparent, where these are others: at most three edges a block.
    """
    weight, last = {}, {}
    parent, depth = tree.parent, tree.depth
    for i, (_, _, element) in enumerate(found):
        near = []
        if i:
            a, b, apart = element, found[i - 1][2], 0
            while a != b:
                if depth[a] >= depth[b]:
                    a = parent[a]
                else:
                    b = parent[b]
                apart += 1
            near.append((i - 1, NEIGHBOUR / max(1, apart)))
        up = element
        for level, w in ((1, SIBLING), (2, COUSIN)):
            if up:
                up = parent[up]
                if (level, up) in last:
                    near.append((last[level, up], w))
                last[level, up] = i
        for j, w in near:
            weight[j, i] = weight.get((j, i), 0.0) + w
    return [(j, i, w) for (j, i), w in weight.items()]


def _reached(n, arcs, to, left, source, sink):
    """Pushes the maximum flow by blocking flows; True for each node that the source still reaches."""
    while True:
        level = [-1] * n
        level[source] = 0
        wave = [source]
        for i in wave:
            for e in arcs[i]:
                if left[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    wave.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level]
        following, path, i = [0] * n, [], source
        while True:
            if i == sink:
                flow = min(left[e] for e in path)
                for k, e in enumerate(path):
                    left[e] -= flow
                    left[e ^ 1] += flow
                full = next(k for k, e in enumerate(path) if left[e] <= 1e-12)
                i = to[path[full] ^ 1]
                del path[full:]
            while following[i] < len(arcs[i]):
                e = arcs[i][following[i]]
                if left[e] > 1e-12 and level[to[e]] == level[i] + 1:
                    break
                following[i] += 1
            if following[i] < len(arcs[i]):
                path.append(arcs[i][following[i]])
                i = to[path[-1]]
            elif i == source:
                break
            else:
                e = path.pop()
                i = to[e ^ 1]
                following[i] += 1


def minimum_cut(unary, pairs):
    """Labels that minimise the sum of unary costs and of the weights of cut pairs.

    ``unary[i]`` is the gain of label True over False. A block whose own capacity exceeds all
    its edges has its label in every minimum cut; such blocks are settled first and their edges
    go to their neighbours' capacities. The rest is a flow network, on which blocking flows over
    level graphs make up the maximum flow; what the source still reaches is content.
    """
    n = len(unary)
    own = list(unary)
    near = [{} for _ in range(n)]
    for i, j, w in pairs:
        if w > 0:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    label = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is not None or abs(own[i]) <= sum(near[i].values()) and near[i]:
            continue
        label[i] = own[i] > 0
        for j, w in near[i].items():
            own[j] += w if label[i] else -w
            del near[j][i]
            if label[j] is None:
                todo.append(j)
        near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if not rest:
        return label
    source, sink = n, n + 1
    arcs, to, left = [[] for _ in range(n + 2)], [], []

    def join(i, j, forth, back):
        arcs[i].append(len(to))
        arcs[j].append(len(to) + 1)
        to.extend((j, i))
        left.extend((forth, back))

    for i in rest:
        if own[i] > 0:
            join(source, i, own[i], 0.0)
        else:
            join(i, sink, -own[i], 0.0)
        for j, w in near[i].items():
            if i < j:
                join(i, j, w, w)
    reached = _reached(n + 2, arcs, to, left, source, sink)
    for i in rest:
        label[i] = reached[i]
    return label


def main_text(page):
    found, tree = blocks(page)
    if not found:
        return ""
    label = minimum_cut(scores(found, tree), edges(found, tree))
    return "\n".join(b[0] for b, content in zip(found, label, strict=True) if content)


@F.pandas_udf(T.StringType())
def extracted(pages: pd.Series) -> pd.Series:
    return pages.map(lambda p: main_text(p) if isinstance(p, str) else "").astype(object)


def extract(pages, page="html"):
    """The pages with their main text in column ``text`` and its code points in ``n_chars``."""
    ready(pages.sparkSession)
    rest = [c for c in pages.columns if c not in ("text", "n_chars", page)]
    found = pages.select(*rest, extracted(F.col(page)).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
