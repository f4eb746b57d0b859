"""HTML tables: grids, flattened rows, cell texts."""

from __future__ import annotations

from folioforge.functions.markup import Node, parsed

#: Fixed value: in documents of this code, tables with images are never structured.
IMAGE_TABLES = "030-030-100"


def span(cell: Node, key: str) -> int:
    """The span of a cell; 1 if it is none or no number."""
    try:
        return int(cell.get(key, "1"))
    except ValueError:
        return 1


def first_table(html: str | Node | None) -> Node | None:
    """The first table of a piece of HTML; a tree is taken as it is."""
    return (html if isinstance(html, Node) else parsed(html or "")).first("table")


def rows_of(table: Node) -> list[list[Node]]:
    return [row.all("th", "td") for row in table.all("tr")]


def cell_text(cell: Node, seen: set[int], between: str = "") -> str:
    """Text of a cell and the descriptions of its images; an image counts for the first cell that has it."""
    images = [x for x in cell.all("img") if id(x) not in seen]
    seen.update(map(id, images))
    shown = " / ".join(alt for x in images if (alt := x.get("alt", "").strip()))
    return " ".join(filter(None, (cell.text(between), f"(이미지: {shown})" if shown else "")))


def is_structured(html: str | Node, filename: str | None = None) -> bool:
    """Whether all rows of the first table have the same number of columns."""
    table = first_table(html)
    if table is None:
        return True
    if IMAGE_TABLES in (filename or "").replace(" ", "") and table.first("img"):
        return False
    return len({sum(span(c, "colspan") for c in row) for row in rows_of(table) if row}) <= 1


def grid(html: str | Node) -> dict | None:
    """n_rows, n_cols, cells and is_header of the first table, spans spelled out; None if it has no rows with cells."""
    table = first_table(html)
    rows = rows_of(table) if table is not None else []
    if not any(rows):
        return None
    width = max(sum(span(c, "colspan") for c in row) for row in rows)
    height = max(len(rows), max(r + span(c, "rowspan") for r, row in enumerate(rows) for c in row))
    at: dict[tuple[int, int], tuple[str, bool]] = {}
    seen: set[int] = set()
    for r, row in enumerate(rows):
        left = 0
        for cell in row:
            while left < width and (r, left) in at:
                left += 1
            value = cell_text(cell, seen), cell.name == "th"
            reach = span(cell, "colspan")
            at.update({(y, x): value for y in range(r, min(height, r + span(cell, "rowspan"))) for x in range(left, min(width, left + reach))})
            left += reach
    empty = ("", False)
    full = [[at.get((y, x), empty) for x in range(width)] for y in range(height)]
    return {"n_rows": height, "n_cols": width, "cells": [[v for v, _ in row] for row in full], "is_header": [[h for _, h in row] for row in full]}


def flattened(table: dict | None) -> list[str]:
    """Rows as `header: value | ...`. As many rows are left out at the top as have a header cell anywhere."""
    if not table:
        return []
    heads = [row for row, is_head in zip(table["cells"], table["is_header"], strict=True) if any(is_head)]
    keys = [" > ".join(h[x] for h in heads if h[x]) or f"col{x + 1}" for x in range(table["n_cols"])]
    return [" | ".join(f"{k}: {v}" for k, v in zip(keys, row, strict=True)) for row in table["cells"][len(heads) :]]


def cell_texts(html: str) -> list[str]:
    """Texts of the first table's cells that aren't empty."""
    table = first_table(html)
    seen: set[int] = set()
    return [t for c in (table.all("th", "td") if table is not None else []) if (t := cell_text(c, seen, " "))]
