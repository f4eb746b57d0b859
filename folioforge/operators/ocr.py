"""Pages read by OCR as documents: boxes, fragments, and one text a document."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.markup import Node, Text, parsed, written

#: Labels that become images, labels of headers and footers, documents that are cropped over the full width, side of the space in which boxes are given.
DIAGRAMS, EDGES, FULL_WIDTH, SPACE = ("Image", "Figure", "Diagram", "Complex-Block"), ("Page-Header", "Page-Footer"), "TP-030-010-030 ", 1024
PADDING, TOP_EXTRA = 15, 30


def _once(value: Column, use) -> Column:
    """use(value), with value worked out once however often it is used there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scaled_box(raw: Column, width: Column, height: Column) -> Column:
    """A box of the SPACE as pixels, inside of the page, however large its numbers; what can't be read is [0, 0, 1, 1], and a number that is none is 0."""
    side = lambda ok, k, length: F.least(F.greatest(F.nanvl(F.coalesce(F.element_at(ok, k + 1), F.lit(0.0)), F.lit(0.0)) * length / SPACE, F.lit(-(2.0**31))), F.lit(2.0**31 - 1)).cast("int")
    box = lambda ok: F.array(F.greatest(F.lit(0), side(ok, 0, width)), F.greatest(F.lit(0), side(ok, 1, height)), F.least(width, side(ok, 2, width)), F.least(height, side(ok, 3, height)))
    none = F.array(*[F.lit(float(x)) for x in (0, 0, 1, 1)])
    return _once(_once(F.from_json(F.coalesce(raw, F.lit("")), "array<double>"), lambda b: F.when(F.size(b) == 4, b).otherwise(none)), box)


def padded_box(box: Column, width: Column, height: Column, full_width: Column | bool = False, padding: int = PADDING, top_extra: int = TOP_EXTRA, bottom_cut: int = 0) -> Column:
    """A box with room around it, most above."""
    full = F.lit(full_width) if isinstance(full_width, bool) else full_width

    def padded(b: Column) -> Column:
        left, top, right, low = (F.element_at(b, k) for k in (1, 2, 3, 4))
        return F.array(
            F.when(full, F.lit(0)).otherwise(F.greatest(F.lit(0), left - padding)),
            F.greatest(F.lit(0), top - (padding + top_extra)),
            F.when(full, width).otherwise(F.least(width, right + padding)),
            F.least(height, low + max(0, padding - bottom_cut)),
        )

    return _once(box, padded)


def has_block_math(node: Node) -> bool:
    return any(m.get("display") == "block" for m in node.all("math"))


def page_fragments(html: str, stem: str, page: int, include_edges: bool = False, folder: str = "components") -> tuple[str, list[dict]]:
    """The page's text, and its assets (label, raw box, image) in order. Blocks of text without markup become paragraphs; diagrams and formulas get an image, tables a link to their snapshot."""
    out, assets, tables = [], [], 0
    for number, block in enumerate((x for x in parsed(html).children if isinstance(x, Node) and x.name == "div"), 1):
        label, formula = block.get("data-label", ""), has_block_math(block)
        if label in EDGES and not include_edges:
            continue
        if label in ("Text", "Title"):
            inside = block.inner().strip()
            if inside and not re.search("<.+>", inside):
                block.children = parsed(f"<p>{inside}</p>").children
        box = block.get("data-bbox")
        if label in DIAGRAMS or formula:
            kind = label or "Math-Block"
            image = block.first("img")
            if image is None:
                image = Node("img")
                block.children.append(image)
            image.attrs["src"] = f"{folder}/{stem}_p{page:03d}_block_{number:02d}.png"
            image.attrs["alt"] = image.get("alt") or f"{kind} snippet"
            assets.append({"label": kind if label in DIAGRAMS else "Math-Block", "bbox": box, "image": image.attrs["src"]})
        if label == "Table":
            tables += 1
            target = f"{folder}/{stem}_p{page:03d}_table_{tables:02d}.png"
            link = Node("p")
            link.children = [Node("a", {"href": target})]
            link.children[0].children = [Text("Table snapshot")]
            block.children.append(link)
            assets.append({"label": "Table", "bbox": box, "image": target})
        out.append("".join(written(x) for x in block.children))
    return "\n\n".join(out), assets


def assembled_pages(pages: DataFrame, include_edges: bool = False) -> DataFrame:
    """doc_key, page, body and assets (page, bbox, image, label) of OCR pages (doc_key, stem, page, html, width, height)."""
    shape = "doc_key string, stem string, page int, width int, height int, body string, found array<struct<label string, bbox string, image string>>"

    def run(batches):
        for pdf in batches:
            done = [page_fragments(h or "", s, int(p), include_edges) for h, s, p in zip(pdf["html"], pdf["stem"], pdf["page"], strict=True)]
            yield pdf[["doc_key", "stem", "page", "width", "height"]].assign(body=[b for b, _ in done], found=[a for _, a in done])

    made = pages.select("doc_key", "stem", "page", "html", "width", "height").mapInPandas(run, shape)
    full, width, height = F.col("stem").startswith(FULL_WIDTH), F.col("width"), F.col("height")
    box = lambda a: padded_box(scaled_box(a["bbox"], width, height), width, height, full)
    assets = F.transform("found", lambda a: F.struct(F.col("page").alias("page"), box(a).alias("bbox"), a["image"].alias("image"), a["label"].alias("label")))
    return made.select("doc_key", "page", "body", assets.alias("assets"))


def assembled_documents(pages: DataFrame) -> DataFrame:
    """doc_key and text: pages (doc_key, page, body) in order, each behind its header."""
    each = F.struct("page", F.concat(F.format_string("<h2>Page %d</h2>\n", "page"), "body").alias("shown"))
    return pages.groupBy("doc_key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(each)), lambda p: p["shown"]), "\n\n<hr/>\n\n").alias("text"))


def without_done(pdfs: DataFrame, done: DataFrame) -> DataFrame:
    """Files whose document isn't there yet."""
    return pdfs.join(done.select("doc_key").distinct(), "doc_key", "left_anti")


def read_pdfs(pdfs: DataFrame, provider, dpi: int = 150, max_pages: int | None = None, crop_top: int = 0) -> DataFrame:
    """doc_key, stem, page, html, width, height and error of PDFs (doc_key, stem, content); one that fails has a row with its error and no page."""
    shape = "doc_key string, stem string, page int, html string, width int, height int, error string"

    def run(batches):
        for pdf in batches:
            rows = []
            for key, stem, content in zip(pdf["doc_key"], pdf["stem"], pdf["content"], strict=True):
                try:
                    rows += [(key, stem, k, h, w, t, None) for k, (h, w, t) in enumerate(provider.pages(bytes(content), dpi, max_pages, crop_top), 1)]
                except Exception as e:  # a file that can't be read is reported, and the others go on
                    rows.append((key, stem, None, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["doc_key", "stem", "page", "html", "width", "height", "error"])

    return pdfs.select("doc_key", "stem", "content").mapInPandas(run, shape)
