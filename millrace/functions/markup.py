"""HTML read as a browser reads it: tags, attributes, comments, raw text, implied end tags and all named entities.

A page is cut by one pattern per state. In content, a token is a comment, another declaration, an end tag, a start tag with
its attributes, or text up to the next of these. After a start tag of a raw-text element the state changes: all is text
until that element's own end tag.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape
from html.entities import html5

_SPACE = r"[ \t\n\f\r]"
# An attribute: a name, maybe a value in either quote or none.
_NAME = r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+"
_VALUE = rf"{_SPACE}*+={_SPACE}*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^ \t\n\f\r>]*+)"
_ATTRIBUTES = rf"(?:[ \t\n\f\r/]++|{_NAME}(?:{_VALUE})?+)*+"
_TOKEN = re.compile(rf"<(?:(!--)|([!?]|/(?![a-zA-Z]))|/([a-zA-Z][^ \t\n\f\r/>]*+){_ATTRIBUTES}>|([a-zA-Z][^ \t\n\f\r/>]*+)({_ATTRIBUTES})>)")
_BEGINS = re.compile(r"<(?:[a-zA-Z!?]|/.)", re.S)
_ATTRIBUTE = re.compile(rf"({_NAME})(?:{_SPACE}*+=({_SPACE}*+(?:\"[^\"]*+\"|'[^']*+'|[^ \t\n\f\r>]*+)))?+")
_COMMENT_END = re.compile(r"(?:(?<=<!--)-?|--!?)>")
_REFERENCE = re.compile(r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)(=?)")

# Fixed values of the HTML standard: elements whose content is text (the second kind with entities written out) ...
RAW_TEXT = {"script", "style", "xmp", "iframe", "noembed", "noframes"}
ESCAPABLE = {"textarea", "title"}
# ... elements without content, ...
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# ... start tags that end an open paragraph, ...
ENDS_PARAGRAPH = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "dd", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li", "listing", "main",
    "menu", "nav", "ol", "p", "plaintext", "pre", "search", "section", "summary", "table", "ul", "xmp",
}
# ... start tags that end open elements of some names, within elements that such an end does not reach out of.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "thead": ({"caption", "colgroup"}, {"table"}),
}
SCOPE = {"table", "td", "th", "caption", "html", "template", "object", "marquee", "applet", "button"}

# kind ("start", "end" or "text"), name or text, attributes as written
Token = tuple[str, str, str]


def tokens(page: str, texts: bool = True) -> Iterator[Token]:
    """Tags and, with ``texts``, text in page order. Comments and declarations are left out; a tag that never ends is dropped with
    what follows."""
    at = 0
    while at < len(page):
        begins = _BEGINS.search(page, at)
        stop = begins.start() if begins else len(page)
        if texts and stop > at:
            yield "text", unescape(page[at:stop]), ""
        found = _TOKEN.match(page, stop)
        if not found:
            return
        comment, other, end, start, attributes = found.groups()
        at = found.end()
        if comment:
            closed = _COMMENT_END.search(page, at)
            at = closed.end() if closed else len(page)
        elif other:
            closed = page.find(">", at)
            at = closed + 1 if closed >= 0 else len(page)
        elif end:
            yield "end", end.lower(), ""
        else:
            name = start.lower()
            yield "start", name, attributes
            if name in RAW_TEXT or name in ESCAPABLE:
                closing = re.compile(rf"</{name}(?=[ \t\n\f\r/>])", re.I).search(page, at)
                inner, at = page[at:closing.start()] if closing else page[at:], closing.start() if closing else len(page)
                if texts and inner:
                    yield ("text", unescape(inner), "") if name in ESCAPABLE else ("raw", inner, "")


def _character(found: re.Match) -> str:
    name, sign = found.groups()
    known = name[0] == "#" or (name in html5 if name[-1] == ";" else name in html5 and not sign)
    return unescape(f"&{name}") + sign if known else found.group()


def attribute(attributes: str, name: str) -> str | None:
    """The value of the first attribute of that name, with its entities written out; None without a value.

    In values, a reference without its semicolon that an equals sign or a letter follows is no reference.
    """
    for found in _ATTRIBUTE.finditer(attributes):
        if found.group(1).lower() == name:
            value = found.group(2)
            if value is None:
                return None
            value = value.lstrip(" \t\n\f\r")
            return _REFERENCE.sub(_character, value[1:-1] if value[:1] in ("'", '"') else value)
    return None


def targets(page: str) -> list[str]:
    """The values of ``href`` of all anchors, in page order, without outer blanks."""
    found = (attribute(attributes, "href") for kind, name, attributes in tokens(page, texts=False) if kind == "start" and name == "a")
    return [t.strip(" \t\n\f\r") for t in found if t is not None]


class _Open:
    """The open elements, with a count of each name, so that a name nobody has open costs no search."""

    def __init__(self):
        self.names: list[str] = []
        self.count: dict[str, int] = {}

    def push(self, name: str) -> None:
        self.names.append(name)
        self.count[name] = self.count.get(name, 0) + 1

    def end(self, names: Iterable[str], within: set[str]) -> None:
        """Ends the innermost open element of these names and all inside it; nothing if an element of ``within`` is in between."""
        if any(self.count.get(n) for n in names):
            for at in range(len(self.names) - 1, -1, -1):
                if self.names[at] in names:
                    self.cut(at)
                    return
                if self.names[at] in within:
                    return

    def cut(self, at: int) -> None:
        while len(self.names) > at:
            self.count[self.names.pop()] -= 1


def element_texts(page: str, tags: Iterable[str]) -> list[str]:
    """The text of each outermost element of these names, in page order. Tags count as blanks, runs of white space as one.

    Elements inside others of these names belong to them. Scripts and styles are no text.
    """
    wanted, open_ = set(tags), _Open()
    out: list[str] = []
    pieces: list[str] | None = None
    depth = 0  # where the outermost element lies in the open ones

    def settle() -> None:
        nonlocal pieces
        if pieces is not None and len(open_.names) <= depth:
            out.append(" ".join(re.sub(r"[ \t\n\f\r]+", " ", "".join(pieces)).strip(" ").split(" ")))
            pieces = None

    for kind, name, _ in tokens(page):
        if kind == "text":
            if pieces is not None:
                pieces.append(name)
            continue
        if kind == "start":
            if name in ENDS_PARAGRAPH:
                open_.end(("p",), SCOPE)
            if name in ENDS:
                names, within = ENDS[name]
                for _ in names:  # a cell, then its row, then their group
                    open_.end(names, within)
            settle()
            if name not in VOID:
                if pieces is None and name in wanted:
                    pieces, depth = [], len(open_.names)
                open_.push(name)
        elif kind == "end":
            open_.end((name,), set() if name in ("table", "html", "body") else SCOPE - {name})
            settle()
        if pieces is not None:
            pieces.append(" ")
    open_.cut(0)
    settle()
    return out
