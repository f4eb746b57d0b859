"""Components of one document: tables with their snapshots, images, and the text with placeholders in their stead."""

from __future__ import annotations

import html as entities
import re

from folioforge.functions.markup import Node, Text, parsed, written
from folioforge.functions.tables import IMAGE_TABLES, flattened, grid, is_structured

_MARKERS = (re.compile(r"<!--\s*페이지번호:\s*(\d+),\s*파일명:\s*(.*?)\s*-->"), re.compile(r"페이지번호:\s*(\d+),\s*파일명:\s*(.+)"))
_HEADING = re.compile(r"^\s*(#{1,6})\s+(.*)")
#: Descriptions that tell what an image shows.
FORMULA, SHOWN = "equation-block snippet", ("figure snippet", "image snippet", "complex-block snippet")


class Place:
    """Where in the document a component stands: page, file name and path of sections."""

    def __init__(self):
        self.page, self.filename, self.path = 1, "", []

    def marker(self, text: str) -> None:
        m = next((m for p in _MARKERS if (m := p.search(text))), None)
        if m:
            self.page, self.filename = int(m[1]), m[2].strip() or self.filename

    def heading(self, level: int, title: str) -> None:
        """Sections nest by how many are open, not by level: a title goes below as many as its level allows."""
        title = re.sub(r"<[^>]+>", "", title).strip()
        if title:
            self.path[max(1, min(level, 6)) - 1 :] = [title]

    def said(self) -> dict:
        return {"section_path": " / ".join(self.path), "filename": self.filename, "page": self.page}


def link_to(folder: str, target: str | None) -> str:
    parts = [p for p in f"output/sanitize/{folder}/{target}".split("/") if p not in ("", ".")]
    return "/".join(parts) if target else ""


def named(kind: str, number: int) -> dict:
    return {"id": f"{kind}_{number:03d}", "placeholder": f"{{{{{kind}_{number:03d}}}}}"}


def _snapshot(node: Node) -> bool:
    link = node.first("a") if node.name == "p" else None
    return link is not None and "table snapshot" in link.text().lower()


def tables_of(text: str, folder: str, code: str) -> tuple[list[dict], list[dict]]:
    """Tables that have a snapshot, and those without one that stand for themselves in documents of IMAGE_TABLES. Tables one after another (paragraphs between them aside) are one."""
    nodes = parsed(f"<root>{text}</root>").children[0].children
    place, found, special, counts = Place(), [], [], {"TB_STR": 0, "TB_UNSTR": 0}
    at = 0
    while at < len(nodes):
        node, at = nodes[at], at + 1
        if isinstance(node, Text):
            if node.kind == "comment":
                place.marker(node)
            else:
                for line in node.splitlines():
                    if m := _HEADING.match(line.strip()):
                        place.heading(len(m[1]), m[2])
            continue
        if re.fullmatch(r"h\d+", node.name):
            place.heading(int(node.name[1]), node.text())
        if node.name != "table":
            continue
        html, shot = written(node), None
        while at < len(nodes) and shot is None:
            after = nodes[at]
            if isinstance(after, Text):
                if after.kind == "comment" or after.strip():
                    break
            elif after.name == "table":
                html += written(after)
            elif after.name != "p":
                break
            elif _snapshot(after):
                shot = after
            at += 1
        if shot is None:
            image = parsed(html).first("img")
            if image is not None and (IMAGE_TABLES in place.filename.replace(" ", "") or IMAGE_TABLES in code.replace(" ", "")):
                name = "COMPLEX_TABLE" + (f"_{len(special) + 1:03d}" if special else "")
                special.append({"placeholder": name, "full_html": html, "image_src": image.get("src", ""), "filename": place.filename, "page": place.page})
            continue
        kind = "TB_STR" if is_structured(html, place.filename) else "TB_UNSTR"
        counts[kind] += 1
        rows = flattened(grid(html)) if kind == "TB_STR" else []
        shown = written(shot)
        found.append(
            named(kind, counts[kind])
            | {"component_type": "table_structured" if kind == "TB_STR" else "table_unstructured", "row_flatten": rows, "table_html": html, "snapshot_html": shown, "full_html": html + shown}
            | {"image_link": link_to(folder, shot.first("a").get("href"))}
            | place.said()
        )
    return sorted(found, key=lambda t: not t["id"].startswith("TB_STR")), special


def formula_text(html: str) -> str:
    return parsed(html).text(" ")


def described(html: str) -> str:
    """What stands around an image: paragraphs without their tags, list items as plain text, lists without attributes."""

    def plain(node: Node) -> Node:
        children = []
        for child in node.children:
            if isinstance(child, Text):
                children.append(child)
                continue
            child = plain(child)
            if child.name == "p":
                children += child.children
                continue
            if child.name == "li":
                child.children = [Text(child.text(" "))]
            if child.name in ("ul", "ol"):
                child.attrs = {}
            children.append(child)
        node.children = children
        return node

    return plain(parsed(html)).inner().strip()


def _without(node: Node, name: str) -> Node:
    node.children = [_without(x, name) if isinstance(x, Node) else x for x in node.children if not (isinstance(x, Node) and x.name == name)]
    return node


def images_of(text: str, folder: str) -> tuple[list[dict], list[dict]]:
    """Images that stand on a line outside of tables: those to summarise (formulas among them) and those to translate."""
    place, summary, translation, before = Place(), [], [], []
    for line in text.splitlines(keepends=True):
        bare = line.strip()
        if "페이지번호" in bare:
            place.marker(bare)
            before = []
            continue
        level, title = bare.count("#") if bare.startswith("#") else 9, bare.lstrip("#")
        tree = parsed(line) if bare else None
        if level > 3 and tree is not None and (head := tree.first("h1", "h2", "h3")) is not None:
            level, title = int(head.name[1]), head.text()
        if level <= 3:
            place.heading(level, title)
            before = []
            continue
        inside = {id(x) for t in tree.all("table") for x in t.all("img")} if tree is not None else set()
        images = [x for x in tree.all("img") if id(x) not in inside] if tree is not None else []
        if not images:
            before.append(line)
            continue
        alt, block = images[0].get("alt", ""), line
        kind = alt.strip().lower()
        if kind == FORMULA and "<math" not in line and "</math>" in line and "<math" in "".join(before):
            block = "".join(before) + line
        around = _without(parsed(block), "img").inner()
        whole = {"full_html": block, "image_link": link_to(folder, images[0].get("src", ""))} | place.said()
        if kind == FORMULA:
            summary.append(named("IMG_SUM", len(summary) + 1) | {"component_type": "image_formula", "description": formula_text(around)} | whole)
        elif kind in SHOWN:
            summary.append(named("IMG_SUM", len(summary) + 1) | {"component_type": "image_summary", "description": described(around)} | whole)
        else:
            translation.append(named("IMG_TR", len(translation) + 1) | {"component_type": "image_trans", "description": alt} | whole)
        before = []
    return summary, translation


def substituted(text: str, html: str, placeholder: str, keep_newline: bool = True) -> tuple[str, bool]:
    """text with the first place where html stands (or, if nowhere, its unescaped form) replaced."""
    for form in dict.fromkeys((html, entities.unescape(html))):
        if form and (at := text.find(form)) >= 0:
            end = "\n" if keep_newline and form.endswith("\n") else ""
            return text[:at] + placeholder + end + text[at + len(form) :], True
    return text, False


def extracted(text: str, folder: str = "", code: str = "") -> dict:
    """tables, images_summary, images_translation and special tables of a document, and its text with placeholders. Each component says whether it was found in the text."""
    tables, special = tables_of(text, folder, code)
    summary, translation = images_of(text, folder)
    out = text
    for item in special:
        out, item["substituted"] = substituted(out, item["full_html"], "{{" + item["placeholder"] + "}}")
    for items, keep in ((tables, True), (summary, True), (translation, False)):
        for item in items:
            out, item["substituted"] = substituted(out, item["full_html"], item["placeholder"], keep)
    return {"tables": tables, "images_summary": summary, "images_translation": translation, "special": special, "text": out}
