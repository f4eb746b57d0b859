"""A small tree for loose HTML, on the standard library's parser: void elements have no inside, an end tag closes the nearest open element of its name or nothing, and no element is closed by another's start."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

#: Elements without an inside, and those whose inside is no text to read.
VOID = frozenset("area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta nextid param source spacer track wbr".split())
SILENT = frozenset(("script", "style", "template"))
_BLANKS = "\n\t\f\r "


class Text(str):
    """Characters of a text, comment, declaration, or inside of a script."""

    kind = "text"


class Node:
    def __init__(self, name: str, attrs: dict[str, str] | None = None):
        self.name, self.attrs, self.children = name, attrs or {}, []

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.attrs.get(key, default)

    def walk(self) -> Iterator[Node | Text]:
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            yield node
            if isinstance(node, Node):
                stack.extend(reversed(node.children))

    def all(self, *names: str) -> list[Node]:
        out, stack = [], self.children[::-1]
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                if x.name in names:
                    out.append(x)
                if x.children:
                    stack += x.children[::-1]
        return out

    def first(self, *names: str) -> Node | None:
        return next((x for x in self.walk() if isinstance(x, Node) and x.name in names), None)

    def text(self, between: str = "") -> str:
        """All text inside, each stretch stripped, blank ones left out."""
        inside = self.children if all(isinstance(x, Text) for x in self.children) else self.walk()
        return between.join([t for x in inside if isinstance(x, Text) and x.kind == "text" and (t := x.strip())])

    def inner(self) -> str:
        return "".join(map(written, self.children))


def _attr(value: str) -> str:
    value = value.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    if '"' not in value:
        return f'"{value}"'
    return '"' + value.replace('"', "&quot;") + '"' if "'" in value else f"'{value}'"


def written(node: Node | Text) -> str:
    """The node as HTML."""
    if isinstance(node, Text):
        if node.kind == "comment":
            return f"<!--{node}-->"
        if node.kind == "declaration":
            return f"<!{node}>"
        return str(node) if node.kind == "raw" else node.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    start = node.name + "".join(f" {k}={_attr(v)}" for k, v in node.attrs.items())
    return f"<{start}/>" if node.name in VOID else f"<{start}>{node.inner()}</{node.name}>"


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open, self.said = [self.root], []

    def flush(self) -> None:
        data, self.said = "".join(self.said), []
        if not data:
            return
        if not data.strip(_BLANKS) and not any(x.name in ("pre", "textarea") for x in self.open):
            data = "\n" if "\n" in data else " "
        self.put(data, "raw" if self.open[-1].name in SILENT else "text")

    def put(self, data: str, kind: str) -> None:
        text = Text(data)
        text.kind = kind
        self.open[-1].children.append(text)

    def handle_starttag(self, tag, attrs):
        self.flush()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.said.append(data)

    def handle_comment(self, data):
        self.flush()
        self.put(data, "comment")

    def handle_decl(self, decl):
        self.flush()
        self.put(decl, "declaration")

    def handle_pi(self, data):
        self.flush()
        self.put(f"?{data}", "declaration")

    def unknown_decl(self, data):
        self.flush()
        self.put(data.removeprefix("CDATA["), "text")


#: Plain markup: tags with quoted attributes, and text, without character references. Elements whose inside is read otherwise are no part of it.
_PLAIN = re.compile(r'<(/?)([A-Za-z][A-Za-z0-9]*)((?: [A-Za-z][A-Za-z0-9-]*="[^"<>&]*")*)(/?)>|([^<&]+)')
_ATTRS = re.compile(r'([A-Za-z][A-Za-z0-9-]*)="([^"]*)"')
_OTHERWISE = SILENT | frozenset("pre textarea title xmp iframe noembed noframes noscript plaintext svg math".split())


def _plain(html: str) -> Node | None:
    """The tree of plain markup, as the parser builds it; None if there is anything else in it."""
    root = Node("")
    open_, at, end = [root], 0, len(html)
    for m in _PLAIN.finditer(html):
        if m.start() != at:
            return None
        at = m.end()
        close, tag, attrs, empty, said = m.groups()
        if said is not None:
            if not said.strip(_BLANKS):
                said = "\n" if "\n" in said else " "
            open_[-1].children.append(Text(said))
            continue
        tag = tag.lower()
        if tag in _OTHERWISE or (close and (attrs or empty)):
            return None
        if close:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].name == tag:
                    del open_[k:]
                    break
            continue
        node = Node(tag, {k.lower(): v for k, v in _ATTRS.findall(attrs)} if attrs else None)
        open_[-1].children.append(node)
        if tag not in VOID and not empty:
            open_.append(node)
    return root if at == end else None


def parsed(html: str) -> Node:
    """The tree of a piece of HTML; its root has no name. Plain markup, which is most of it, doesn't need the parser."""
    root = _plain(html)
    if root is not None:
        return root
    builder = _Builder()
    builder.feed(html)
    builder.close()
    builder.flush()
    return builder.root
