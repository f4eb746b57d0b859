"""Headings of a document, in one pass over its lines."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from folioforge.functions.mathtext import BLOCK, INLINE
from folioforge.functions.text import TOP_TITLES, TOP_VARIANTS

MAJOR, MINOR = range(1, 7), range(31)
_TOP = tuple(re.sub(r"[.\s]+", "", t) for t in TOP_TITLES) + TOP_VARIANTS
_NUMBERED = re.compile(r"^(\d+(?:\.\d+)*)\.?\s+(.+)$")
_MARKED = re.compile(r"^(#{1,6})\s+(.*)$")
_LISTED = re.compile(r"^(?:[가-힣]\.|\d+\)\s+.)")
_PARAGRAPH = re.compile(r"<p>\s*(.*?)\s*</p>", re.I | re.S)
_TAG = re.compile(r"<[^>]+>")


def label_parts(label: str) -> list[int] | None:
    """The numbers of a label, if the first is 1 to 6 and the others 0 to 30."""
    if not all(p.isdigit() for p in label.split(".")):
        return None
    parts = [int(p) for p in label.split(".")]
    return parts if parts[0] in MAJOR and all(p in MINOR for p in parts[1:]) else None


def is_top(title: str) -> bool:
    bare = re.sub(r"[.\s]+", "", title)
    return any(t in bare for t in _TOP)


@dataclass
class _Outline:
    """What the headings so far decide about the next: the level, the numbers and the level of the last numbered one."""

    found: list[tuple[int, str]] = field(default_factory=list)
    level: int = 0
    numbers: list[int] = field(default_factory=list)
    numbered_level: int = 0

    def fits(self, parts: list[int]) -> bool:
        """From the third depth on, a number must lie under the last one's parent."""
        up = len(parts) - 1
        return up < 2 or not self.numbers or self.numbers[:up] == parts[:up]

    def depth(self, parts: list[int], title: str) -> int:
        return 1 if is_top(title) else min(len(parts), 5)

    def add(self, level: int, title: str, parts: list[int] | None = None) -> str:
        level = min(level, self.level + 1) if self.level else level
        self.level = level
        self.found.append((level, title))
        if parts is not None:
            self.numbers, self.numbered_level = parts, level
        return "#" * level + " " + title

    def line(self, line: str) -> str:
        said = line.strip()
        if p := _PARAGRAPH.match(said):
            said = _TAG.sub("", p[1]).strip()
        if m := _MARKED.match(said):
            inner = _NUMBERED.match(m[2])
            parts = label_parts(inner[1]) if inner else None
            if parts and self.fits(parts):
                return self.add(self.depth(parts, m[2]), m[2], parts)
            return self.add(1 if is_top(m[2]) else len(m[1]), m[2])
        if m := _NUMBERED.match(said):
            parts = label_parts(m[1])
            if parts and parts != self.numbers and self.fits(parts):
                return self.add(self.depth(parts, m[2]), f"{m[1]} {m[2]}", parts)
            return line
        if _LISTED.match(said):
            return self.add(min(self.numbered_level + 1, 6), said) if self.numbered_level else f"<p>{line.strip()}</p>"
        return line


def outlined(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The text with all headings as Markdown, and their levels and titles."""
    text = re.sub(r"<h([1-6])>(.*?)</h\1>", lambda m: "#" * int(m[1]) + f" {_TAG.sub('', m[2]).strip()}\n", text, flags=re.I | re.S)
    outline = _Outline()
    return "\n".join([outline.line(x) for x in text.splitlines()]), outline.found


def with_formula_headings(text: str) -> str:
    """For collections of formulas: a block that begins with a number gets a heading of what stands before its equals sign; inline formulas lose their tags."""

    def block(m: re.Match) -> str:
        body = INLINE.sub(r"\1", m[2])
        number = re.match(r"(\d+(?:\.\d+){1,2})([^=\n]*)", body.lstrip())
        parts = label_parts(number[1]) if number else None
        heading = "#" * min(len(parts), 3) + " " + f"{number[1]} {number[2].strip()}".strip() + "\n" if parts else ""
        return heading + m[1] + body + m[3]

    return INLINE.sub(r"\1", BLOCK.sub(block, text))
