"""Main text of HTML pages: a linear-chain conditional random field over DOM leaf blocks."""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements of formulas, which stand in the text (annotations are hidden, but end no block either).
MATH = frozenset(
    "math annotation annotation-xml maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
#: Elements that do not end a block.
INLINE = MATH | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown, or is not prose.
HIDDEN = frozenset("script style noscript template textarea select option svg annotation annotation-xml iframe object canvas audio video head title button datalist".split())
#: Elements that can stand in a head; any other one, and text, ends it.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Elements whose content is plain text up to their end tag.
RAW = frozenset("script style textarea title iframe noscript".split())

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_MARKS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+")


def _self_closed(attributes: str) -> bool:
    """Whether a tag ends in '/>', where the slash is not the end of an unquoted value."""
    if not attributes.endswith("/"):
        return False
    start = max(attributes.rfind(c) for c in " \t\n\f\r\"'") + 1
    value = attributes[start:]
    return "=" not in value and not (value == "/" and attributes[:start].rstrip().endswith("="))


class Block:
    """A leaf block: its text, its known ancestors' features, the element that holds its own one, and the characters inside links."""

    __slots__ = ("text", "marks", "parent", "linked")

    def __init__(self, text: str, marks: frozenset, parent: int, linked: int):
        self.text, self.marks, self.parent, self.linked = text, marks, parent, linked


def leaf_blocks(page: str, known: frozenset | None = None) -> list[Block]:
    """Blocks in page order, with character references decoded and white space folded.

    A block ends at every tag that is not inline; ``br`` counts as white space.
    ``known`` limits the ancestors' features, so deep nesting costs no more than
    the model has features. One pass over the page; unclosed elements end with it,
    a head at the first element or text that cannot stand in it. '/>' closes svg, math and what they hold.
    """
    blocks: list[Block] = []
    # name, features of this element and its ancestors, number of the element
    stack: list[tuple[str, frozenset, int]] = [("", frozenset(), 0)]
    opened: Counter = Counter()
    parts: list[str] = []
    state = {"links": 0, "linked": 0, "hidden": 0, "count": 0}

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            outer = list(islice((x for x in reversed(stack) if x[0] not in INLINE), 2))
            blocks.append(Block(text, outer[0][1], outer[1][2] if len(outer) > 1 else 0, state["linked"]))
        parts.clear()
        state["linked"] = 0

    def pop() -> None:
        name = stack.pop()[0]
        opened[name] -= 1
        state["links"] -= name == "a"
        state["hidden"] -= name in HIDDEN

    def words(text: str) -> None:
        if stack[-1][0] == "head" and text.strip(" \t\n\f\r"):
            pop()
        if not state["hidden"] and text:
            text = html.unescape(text)
            parts.append(text)
            if state["links"]:
                state["linked"] += len(text)

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            words(page[at:])
            break
        if lt > at:
            words(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        m = _NAME.match(page, lt + 1)
        if m is None:
            if page[lt + 1 : lt + 2] in ("!", "?", "/"):
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                words("<")
                at = lt + 1
            continue
        rest = _REST.match(page, m.end())
        end = rest.end() if rest else page.find(">", m.end()) + 1
        if not end:
            break  # a tag that the page's end cuts off
        name, closing, attributes = m[1].lower(), page[lt + 1] == "/", page[m.end() : end - 1]
        at = end
        if stack[-1][0] == "head" and (name in ("body", "html", "br") if closing else name not in IN_HEAD):
            pop()
        if name == "head" and not closing and any(x[0] not in ("", "html") for x in stack):
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            flush()
        if closing:
            if opened[name] > 0:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name not in INLINE:
            tail = len(stack) - 1
            while stack[tail][0] in INLINE:
                tail -= 1
            if stack[tail][0] == "p" or stack[tail][0] == name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                while len(stack) > tail:
                    pop()
        if name in ("mtr", "mtd"):
            words(" ")
        if name in VOID or (name in ("svg", "math") or opened["svg"] or opened["math"]) and _self_closed(attributes):
            continue
        marks = [f"<{name}"] if name not in INLINE else []
        for found in _MARKS.finditer(attributes):
            marks += [f".{x.lower()}" for x in _PARTS.findall(found[1] or found[2] or found[3] or "")]
        own = frozenset(m for m in marks if known is None or m in known)
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = end.start() if end else n
        state["count"] += 1
        state["links"] += name == "a"
        state["hidden"] += name in HIDDEN
        opened[name] += 1
        stack.append((name, stack[-1][1] | own if own else stack[-1][1], state["count"]))
    flush()
    return blocks


_HOLD = frozenset(("<article", "<main"))


def has_holder(blocks: list[Block]) -> bool:
    return any(not _HOLD.isdisjoint(b.marks) for b in blocks)


def block_features(block: Block, holder: bool) -> list[str]:
    """Names of the features that hold: ancestors' tags and marks, the look of the text, and for pages with an article element whether the block is in it."""
    text = block.text
    words = text.count(" ") + 1
    share = block.linked / max(1, len(text))
    return [
        *block.marks,
        ("outside" if _HOLD.isdisjoint(block.marks) else "within") if holder else "bare",
        f"words{min(6, words.bit_length())}",
        f"links{0 if share < 0.1 else 1 if share < 0.5 else 2 if share < 0.9 else 3}",
        "stop" if text[-1] in ".!?…:;\"'”»)" else "open",
        f"commas{min(3, text.count(','))}",
        "sign" if any(c in text for c in "©®™»›") else "plain",
        "bias",
    ]


class Crf:
    """Two labels, 1 for main text; transitions depend on whether neighbours are siblings."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray):
        self.weights, self.moves = weights, moves.tolist()
        self.known = frozenset(weights)

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels (Viterbi)."""
        back: list[tuple[int, int]] = []
        a = b = 0.0
        holder = has_holder(blocks)
        for t, block in enumerate(blocks):
            e = sum(self.weights.get(f, 0.0) for f in block_features(block, holder))
            if t:
                m = self.moves[block.parent == blocks[t - 1].parent]
                from0, from1 = (a + m[0][0], b + m[1][0]), (a + m[0][1], b + m[1][1])
                back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
                a, b = max(from0), max(from1) + e
            else:
                a, b = 0.0, e
        labels = [int(b > a)] if blocks else []
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def text(self, page: str | None) -> str:
        if not page:
            return ""
        blocks = leaf_blocks(page, self.known)
        return " ".join(b.text for b, y in zip(blocks, self.decode(blocks), strict=True) if y)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(pages: list[tuple[str, list[int]]], steps: int = 120, rate: float = 0.2, penalty: float = 0.005) -> Crf:
    """Maximise the penalised conditional likelihood of the labels, with exact gradients from forward and backward sums over all pages at once."""
    parsed = [(leaf_blocks(page), labels) for page, labels in pages]
    names: dict[str, int] = {}
    width = max(len(b) for b, _ in parsed)
    n = len(parsed)
    y = np.zeros((n, width), dtype=int)
    mask = np.zeros((n, width))
    same = np.zeros((n, width), dtype=int)
    cells, features = [], []
    for i, (blocks, labels) in enumerate(parsed):
        holder = has_holder(blocks)
        for t, (block, label) in enumerate(zip(blocks, labels, strict=True)):
            y[i, t], mask[i, t] = label, 1
            same[i, t] = t > 0 and block.parent == blocks[t - 1].parent
            for f in block_features(block, holder):
                cells.append(i * width + t)
                features.append(names.setdefault(f, len(names)))
    cells_, features_ = np.array(cells), np.array(features)
    theta = np.zeros(len(names) + 8)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    pairs = np.zeros((n, width, 2, 2))
    for t in range(1, width):
        pairs[np.arange(n), t, y[:, t - 1], y[:, t]] = mask[:, t]
    for step in range(1, steps + 1):
        moves = theta[-8:].reshape(2, 2, 2)
        emit = np.zeros((n, width, 2))
        emit[..., 1] = np.bincount(cells_, weights=theta[:-8][features_], minlength=n * width).reshape(n, width)
        forward, backward = np.zeros((n, width, 2)), np.zeros((n, width, 2))
        forward[:, 0] = emit[:, 0]
        for t in range(1, width):
            nxt = _log_sum(forward[:, t - 1, :, None] + moves[same[:, t]], 1) + emit[:, t]
            forward[:, t] = np.where(mask[:, t, None] > 0, nxt, forward[:, t - 1])
        for t in range(width - 2, -1, -1):
            prev = _log_sum(moves[same[:, t + 1]] + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None] > 0, prev, 0.0)
        log_z = _log_sum(forward[:, -1], 1)
        marginal = np.exp(forward[..., 1] + backward[..., 1] - log_z[:, None])
        grad = np.zeros_like(theta)
        grad[:-8] = np.bincount(features_, weights=((y - marginal) * mask).ravel()[cells_], minlength=len(names))
        joint = np.exp(forward[:, :-1, :, None] + moves[same[:, 1:]] + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - log_z[:, None, None, None]) * mask[:, 1:, None, None]
        gap = pairs[:, 1:] - joint
        grad[-8:] = np.stack([gap[same[:, 1:] == k].sum(axis=0) for k in (0, 1)]).ravel()
        grad = grad / n - penalty * theta / 10
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Crf({name: float(theta[k]) for name, k in names.items()}, theta[-8:].reshape(2, 2, 2))


class _Page:
    """Writes a labelled page: markup beside the label of every block."""

    def __init__(self, rng: random.Random):
        self.rng, self.out, self.labels = rng, [], []

    def raw(self, *markup: str) -> None:
        self.out += markup

    def words(self, low: int, high: int) -> list[str]:
        return ["".join(self.rng.choice("aeioustrnlmdc") for _ in range(self.rng.randint(2, 9))) for _ in range(self.rng.randint(low, high))]

    def sentence(self, low: int, high: int) -> str:
        w = self.words(low, high)
        for k in range(5, len(w) - 1, 7):
            w[k] += ","
        return " ".join(w).capitalize() + "."

    def block(self, tag: str, text: str, label: int, inside: str = "", attrs: str = "") -> None:
        r = self.rng.random()
        if inside:
            text = f"<{inside} href='/x'>{text}</{inside}>" if inside == "a" else f"<{inside}>{text}</{inside}>"
        elif r < 0.15:
            text = f"<b>{text.split(' ')[0]}</b> {text} <a href=\"/y\">{self.words(1, 2)[0]}</a>."
        self.out.append(f"<{tag}{attrs}>{text}" + ("" if tag in ("p", "li") and self.rng.random() < 0.2 else f"</{tag}>"))
        self.labels.append(label)


#: Boilerplate of the training pages: kind, its elements, its marks.
_AROUND = {
    "menu": (("nav", "ul", "div"), ("nav", "menu", "navbar", "navigation", "main-menu", "breadcrumb", "breadcrumbs", "topbar", "toc", "pagination", "pager", "skip-link", "tabs")),
    "header": (("header", "div"), ("header", "masthead", "site-header", "banner", "page-header", "logo", "branding", "tagline")),
    "footer": (("footer", "div"), ("footer", "site-footer", "copyright", "legal", "bottom", "colophon")),
    "sidebar": (("aside", "div", "section"), ("sidebar", "side", "widget", "related", "recommended", "popular", "trending", "more-stories", "see-also", "author-box", "tags", "rail", "secondary")),
    "notice": (("div", "section", "aside"), ("notice", "cookie-notice", "cookie", "consent", "gdpr", "alert", "warning", "popup", "modal", "overlay", "paywall", "message", "disclaimer", "subscribe")),
    "advert": (("div", "aside", "section"), ("ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "banner-ad", "promotion", "dfp", "adsbox", "partner")),
    "form": (("form", "div"), ("form", "newsletter", "signup", "search", "login", "contact-form", "search-form", "feedback")),
    "share": (("div", "ul"), ("share", "social", "sharing", "follow", "share-buttons")),
    "comments": (("section", "div", "ol"), ("comments", "comment", "comment-list", "discussion", "replies", "responses", "reader-comments", "disqus", "respond")),
}
_HOLDERS = (("article", ""), ("article", "post"), ("main", ""), ("main", "content"), ("div", "content"), ("div", "article-body"), ("div", "post-content"), ("section", "entry-content"), ("div", "story"), ("div", "main"), ("td", "text"), ("div", "article"), ("section", "body"), ("body", ""), ("body", ""), ("div", "text"), ("td", ""))
_NEUTRAL = ("container", "row", "wrap", "inner", "col", "box", "grid", "site", "page")


def _around(page: _Page, kind: str) -> None:
    rng = page.rng
    tags, marks = _AROUND[kind]
    tag = rng.choice(tags)
    named = tag in ("div", "section", "ul", "ol") or rng.random() < 0.4
    attrs = f' {rng.choice(("class", "class", "id"))}="{rng.choice(marks)}"' if named else ""
    page.raw(f"<{tag}{attrs}>")
    if kind in ("menu", "share"):
        page.raw("" if tag == "ul" else "<ul>")
        for _ in range(rng.randint(2, 8)):
            page.block("li", " ".join(page.words(1, 3)), 0, "a")
        page.raw("" if tag == "ul" else "</ul>")
    elif kind == "comments":
        page.block("h3", " ".join(page.words(1, 3)), 0)
        for _ in range(rng.randint(1, 5)):
            page.raw(rng.choice(('<div class="comment">', "<li>", "<div>", '<article class="comment">')))
            page.block("p", page.sentence(3, 40), 0)
            page.raw("</div>")
    elif kind == "form":
        page.block("p", page.sentence(3, 10), 0)
        page.raw('<input name="q"><button>go</button>')
    elif kind == "footer":
        for _ in range(rng.randint(1, 3)):
            page.block(rng.choice(("p", "div")), rng.choice(("&copy; ", "&copy; ", "")) + rng.choice((" &middot; ", " | ", " ")).join(page.sentence(1, 9) for _ in range(rng.randint(1, 3))), 0)
    elif kind == "sidebar" and rng.random() < 0.6:
        page.block("h3", " ".join(page.words(1, 3)), 0)
        page.raw("<ul>")
        for _ in range(rng.randint(2, 6)):
            page.block("li", " ".join(page.words(2, 9)), 0, "a")
        page.raw("</ul>")
    else:
        for _ in range(rng.randint(1, 3)):
            page.block(rng.choice(("p", "p", "div", "h4")), page.sentence(2, 30), 0)
    page.raw(f"</{tag}>")


def labelled_page(rng: random.Random) -> tuple[str, list[int]]:
    """One training page: an article among boilerplate of known kinds, in a random layout; a few pages are bare text."""
    page = _Page(rng)
    if rng.random() < 0.04:
        page.raw(" ".join(page.sentence(2, 20) for _ in range(rng.randint(1, 6))))
        return page.out[0], [1]
    page.raw('<!DOCTYPE html><html><head><meta charset="utf-8"><title>x y</title><style>p{}</style><script>var a="<p>";</script></head><body>')
    before = [k for k in ("header", "menu", "menu", "notice", "advert", "form", "share", "sidebar") if rng.random() < 0.4]
    after = [k for k in ("share", "sidebar", "advert", "form", "comments", "comments", "notice", "menu", "footer", "footer") if rng.random() < 0.45]
    rng.shuffle(before)
    outer = rng.randint(0, 2)
    page.raw("".join(f'<div class="{rng.choice(_NEUTRAL)}">' for _ in range(outer)))
    for kind in before:
        _around(page, kind)
    tag, mark = rng.choice(_HOLDERS)
    if tag != "body":
        page.raw(f'<{tag} class="{mark}">' if mark else f"<{tag}>")
    odd = rng.choice(("", "", "", "", " | ", "!! ", "%%% "))
    if rng.random() < 0.8:
        inner = rng.random() < 0.2
        page.raw("<header>" if inner else "")
        page.block(rng.choice(("h1", "h1", "h2")), " ".join(page.words(2, 12)), 1)
        page.raw("</header>" if inner else "")
    for _ in range(rng.randint(1, 14)):
        r = rng.random()
        if r < 0.68:
            text = " ".join(page.sentence(2, 20) for _ in range(rng.randint(1, 6)))
            page.block("p", text.replace(" ", odd) if odd and rng.random() < 0.7 else text, 1)
        elif r < 0.76:
            page.block(rng.choice(("h2", "h3")), " ".join(page.words(1, 8)), 1)
        elif r < 0.84:
            page.raw("<ul>")
            for _ in range(rng.randint(2, 5)):
                page.block("li", page.sentence(1, 12), 1)
            page.raw("</ul>")
        elif r < 0.88:
            page.raw("<blockquote>")
            page.block("p", page.sentence(5, 30), 1)
            page.raw("</blockquote>")
        elif r < 0.91:
            page.raw("<table><tr>")
            for _ in range(rng.randint(2, 4)):
                page.block("td", " ".join(page.words(1, 3)), 1)
            page.raw("</tr></table>")
        elif r < 0.93:
            page.raw("<figure>")
            page.block("figcaption", page.sentence(3, 12), 1)
            page.raw("</figure>")
        else:
            _around(page, rng.choice(("advert", "advert", "notice", "sidebar", "share", "form")))
    if rng.random() < 0.12:
        _around(page, "comments")
    if tag != "body":
        page.raw(f"</{tag}>")
    for kind in sorted(after, key=lambda k: (k == "footer", rng.random())):
        _around(page, kind)
    page.raw("</div>" * outer, "</body></html>")
    return "".join(page.out), page.labels


@lru_cache(maxsize=4)
def default_model(n_pages: int = 320, seed: int = 5) -> Crf:
    """The field trained on ``n_pages`` labelled pages, which are written here with their labels."""
    rng = random.Random(seed)
    pages = []
    while len(pages) < n_pages:
        page, labels = labelled_page(rng)
        if len(leaf_blocks(page)) == len(labels):
            pages.append((page, labels))
    return train(pages)


def main_text(pages: DataFrame, html_col: str = "html", name: str = "text", model: Crf | None = None) -> DataFrame:
    """``pages`` with the main text of each whole page.

    Null and empty pages, and pages without main text, give an empty string.
    Pages are handled alone in one pass, of any length; an existing column
    ``name`` is replaced. The model (a few hundred weights) travels with the tasks.
    """
    field = model or default_model()
    weights, moves = field.weights, np.array(field.moves)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Crf(weights, moves)
        for texts in batches:
            yield pd.Series([own.text(t) for t in texts], dtype=object)

    return pages.withColumn(name, extract(F.col(html_col)))
