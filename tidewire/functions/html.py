"""Small HTML reader used inside Arrow functions: headings and what follows them."""

from __future__ import annotations

from html.parser import HTMLParser

_SKIP = {"script", "style"}
_TEXT_BLOCKS = {"p", "div", "span"}
_NAME_BLOCKS = {"strong", "p", "div"}
_CLOSES_P = {"p", "div", "ul", "ol", "li", "h1", "h2", "h3", "h4", "h5", "h6", "article", "footer", "nav", "section"}


class _Events(HTMLParser):
    """Document as a flat list of elements in order of their start tags, each with
    the text it encloses."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[tuple[str, dict[str, str | None], list[str], int]] = []
        self._open: list[tuple[str, list[str]]] = []

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in _CLOSES_P and any(t == "p" for t, _ in self._open):
            self._close("p")
        if tag == "li" and self._open and self._open[-1][0] == "li":
            self._open.pop()
        parts: list[str] = []
        self.elements.append((tag, dict(attrs), parts, len(self._open)))
        if tag not in ("br", "img", "hr", "meta", "link", "input"):
            self._open.append((tag, parts))

    def handle_endtag(self, tag: str) -> None:
        self._close(tag)

    def _close(self, tag: str) -> None:
        if any(t == tag for t, _ in self._open):
            while self._open and self._open.pop()[0] != tag:
                pass

    def handle_data(self, data: str) -> None:
        if self._open and self._open[-1][0] in _SKIP:
            return
        cleaned = " ".join(data.split())
        if cleaned:
            for _, parts in self._open:
                parts.append(cleaned)


def read(html: str) -> list[tuple[str, dict, list[str], int]]:
    events = _Events()
    events.feed(html or "")
    events.close()
    return events.elements


def after_heading(html: str, tag: str, heading: str | None, lenient: bool, nth_list: int) -> dict:
    """Text block, list items, first link and name after a heading.

    ``heading=None`` takes the first heading of the tag; ``lenient`` accepts a
    heading that contains the text, ignoring case.
    """
    elements = read(html)

    def is_heading(parts: list[str]) -> bool:
        text = " ".join(parts)
        if heading is None:
            return True
        return heading.lower() in text.lower() if lenient else text == heading

    at = next((i for i, (t, _, parts, _) in enumerate(elements) if t == tag and is_heading(parts)), None)
    if at is None:
        return {"text": None, "items": [], "link": None, "name": None}
    depth = elements[at][3]
    inside = at + 1
    while inside < len(elements) and elements[inside][3] > depth:
        inside += 1
    rest = elements[inside:]
    block = next((parts for t, _, parts, _ in rest if t in _TEXT_BLOCKS), [])
    lists = [i for i, (t, _, _, _) in enumerate(rest) if t == "ul"]
    items: list[str] = []
    if len(lists) >= nth_list:
        start = lists[nth_list - 1]
        level = rest[start][3]
        for t, _, parts, d in rest[start + 1 :]:
            if d <= level:
                break
            if t == "li" and d == level + 1 and parts:
                items.append(" ".join(parts))
    link = next((a.get("href") for t, a, _, _ in rest if t == "a" and a.get("href")), None)
    pieces = next((parts for t, _, parts, _ in rest if t in _NAME_BLOCKS), [])
    name = next(
        (p for p in pieces if "@" not in p and not any(c.isdigit() for c in p) and len(p.split()) <= 5), None
    )
    return {"text": " ".join(block) or None, "items": items, "link": link, "name": name}
