"""Readable text of one document, and its chunks."""

from __future__ import annotations

import bisect
import re

from folioforge.functions.markup import Node, Text, parsed

_MARKER = re.compile(r"페이지번호:\s*(\d+),\s*파일명:\s*(.*?)\s*-->")
_HEADING = re.compile(r"^(#{1,6})\s+(.*)")
_NUMBER = re.compile(r"^\d+(?:\.\d+)*(?:\.)?(?=\s|$)")
PLACEHOLDER = re.compile(r"\{\{([^{}]+)\}\}")


def _flat(node: Node) -> str:
    return " ".join(node.text(" ").split())


def list_lines(node: Node, depth: int = 0) -> list[str]:
    """A line for each item, with a bullet, number or letter; the items of a list in an item come after it, further in."""
    out = []
    for k, item in enumerate((x for x in node.children if isinstance(x, Node) and x.name == "li"), 1):
        mark = "●" if node.name != "ol" else f"{chr(64 + k)}." if node.get("type", "").upper() == "A" else f"{k}."
        if said := _flat(item):
            out.append(f"{'  ' * depth}{mark} {said}")
        for inner in item.children:
            if isinstance(inner, Node) and inner.name in ("ul", "ol"):
                out += list_lines(inner, depth + 1)
    return out


def _read(node: Node | Text, out: list[str]) -> None:
    if isinstance(node, Text):
        said = node.strip()
        if said and node.kind == "comment":
            out += [f"<!-- {said} -->", ""]
        elif said:
            out.append(said)
    elif node.name in ("p", "div", "section") or re.fullmatch(r"h\d+", node.name):
        if said := _flat(node):
            out += [said, ""]
    elif node.name in ("ul", "ol"):
        out += [*list_lines(node), ""]
    elif node.name == "br":
        out.append("")
    elif node.name != "hr":
        for child in node.children:
            _read(child, out)


def readable(html: str) -> str:
    """Text of loose HTML: blocks as paragraphs, lists as lines, comments kept."""
    out: list[str] = []
    _read(parsed(f"<root>{html}</root>"), out)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(x.rstrip() for x in out)).strip()


def chunks(text: str, strict: bool = False) -> list[dict]:
    """section_path, pages, filename and text of each chunk. A numbered heading begins a chunk; other headings change the path from there on, or in strict mode are plain text."""
    out: list[dict] = []
    lines: list[str] = []
    path: list[str] = []
    numbers: list[str] = []
    pages: list[int] = []
    filename = None

    def close() -> None:
        nonlocal pages
        said = "\n".join(lines).strip()
        if said:
            out.append({"section_path": " / ".join(path), "pages": list(pages), "filename": filename, "text": said})
            pages = pages[-1:]
        lines.clear()

    for line in text.splitlines():
        bare = line.strip()
        if bare.startswith("<!-- 페이지번호:"):
            if m := _MARKER.search(bare):
                if filename and m[2] != filename:
                    close()
                    path, numbers, pages = [], [], []
                filename = m[2]
                if int(m[1]) not in pages:
                    pages.append(int(m[1]))
            continue
        head = _HEADING.match(bare)
        number = _NUMBER.match(head[2].strip()) if head else None
        if head and (number or not strict):
            level, title = len(head[1]), head[2].strip()
            parent = numbers[level - 2] if strict and 1 < level <= len(numbers) + 1 else None
            if number:
                close()
            path, numbers = path[: level - 1], numbers[: max(0, len(numbers) - max(0, len(path) - level + 1))]
            own = number[0].rstrip(".") if number else ""
            if parent and not own.startswith(parent + "."):
                path, numbers = [], []
            path.append(title)
            if strict:
                numbers.append(own)
        lines.append(line)
    close()
    return out


def windows(text: str, size: int, overlap: int = 0) -> list[str]:
    """Pieces of about `size` characters that overlap, no placeholder cut in two; blank ones left out. Without a size, the text itself."""
    if size <= 0:
        return [text]
    marks = [m.span() for m in re.finditer(r"\{\{[^{}]+\}\}", text)]
    begins = [s for s, _ in marks]

    def around(at: int) -> tuple[int, int]:
        """The placeholder that `at` would cut in two, or `at` itself."""
        k = bisect.bisect_left(begins, at) - 1
        return marks[k] if k >= 0 and at < marks[k][1] else (at, at)

    out, start = [], 0
    while start < len(text):
        end = min(start + size, len(text))
        end = around(end)[1] if end < len(text) else end
        if said := text[start:end].strip():
            out.append(said)
        if end == len(text):
            break
        step = end - max(overlap, 0)
        step = step if step > start else end
        back = around(step)[0]
        start = back if back > start else end
    return out
