"""Text rules as Column expressions: all run inside the JVM and are pushed with the plan.

\\s and \\d follow Unicode ((?U)), as white space in scanned documents often isn't ASCII.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Page markers, top-level headings with the misread variants that scans have, noise lines, phrases of sections without content, protected terms.
PAGE_HEADER = r"(?U)<h2>Page\s+\d+</h2>"
MARKER = "<!-- 페이지번호: {page}, 파일명: {filename} -->"
TOP_TITLES = ("1. 적용범위", "2. 목적", "3. 중점관리 항목", "4. 조업기준", "5. 이상판단 및 조치기준", "6. 기술이론")
TOP_VARIANTS = ("3증정관리항목", "4조업관리기준", "3종점관리항목", "5이상판단및조치기준")
NOISE = ("뒷장계속", "이하여백", "끝")
NO_CONTENT = ("해당사항없음", "해당없음")
PROTECTED = ("품질영향인자", "공정영향인자")
#: Characters at which lines end besides line feeds.
LINE_ENDS = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x85\u2028\u2029]"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def collapsed(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def compact(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", "")


def lines_of(c: Column) -> Column:
    """The lines of a text; a line end at the end opens no further line, and an empty text has none."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, rf"(?:{LINE_ENDS})\z", ""), LINE_ENDS))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once, however often use names it, also within lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def pages_of(c: Column) -> Column:
    """array<struct<page, body>>: what stands after each page header; without headers the whole text is page 1."""
    numbers = F.regexp_extract_all(c, F.lit(r"(?U)<h2>Page\s+(\d+)</h2>"), F.lit(1))
    bodies = F.split(c, PAGE_HEADER)
    found = F.zip_with(numbers, F.slice(bodies, F.lit(2), F.greatest(F.size(bodies) - 1, F.lit(0))), lambda n, b: F.struct(n.alias("page"), stripped(b).alias("body")))
    return F.when(F.size(numbers) == 0, F.array(F.struct(F.lit("1").alias("page"), stripped(c).alias("body")))).otherwise(found)


def display_name(filename: Column) -> Column:
    """The file's name without its suffix and without what follows `(Rev`."""
    name = F.regexp_extract(filename, r"([^/]*)/*$", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    return collapsed(F.regexp_replace(stem, r"(?s)\(Rev.*$", ""))


def prefix_name(filename: Column) -> Column:
    """As display_name(), without a TP code that a title follows."""
    base = display_name(F.coalesce(filename, F.lit("")))
    title = F.regexp_extract(base, r"(?U)^TP-\d{3}-\d{3}-\d{3}\s+(.+)$", 1)
    return F.when(title != "", title).otherwise(base)


def with_markers(c: Column, filename: Column) -> Column:
    """Pages one after another, each behind its marker."""
    head, middle, tail = MARKER.replace("{page}", "\0").replace("{filename}", "\0").split("\0")

    def page(p: Column) -> Column:
        marker = F.concat(F.lit(head), p["page"], F.lit(middle), display_name(filename), F.lit(tail))
        return F.when(p["body"] == "", marker).otherwise(F.concat(marker, F.lit("\n"), p["body"]))

    return F.array_join(F.transform(pages_of(c), page), "\n\n")


def eta_co(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)η\s*_\s*\{?\s*CO\s*\}?", "ηCO")


def with_first_heading(c: Column, titles: Column) -> Column:
    """The first top-level heading behind the first page marker, unless a heading has its title."""
    want = TOP_TITLES[0].replace(" ", "")
    has = F.exists(titles, lambda t: F.contains(compact(t), F.lit(want)))
    marker = r"<!-- 페이지번호: [^>]+ -->"
    first = F.regexp_extract(c, f"({marker})", 1)
    at = F.instr(c, F.when(first == "", F.lit("\0")).otherwise(first))
    split = F.concat(F.substr(c, F.lit(1), at + F.length(first) - 1), F.lit(f"\n# {TOP_TITLES[0]}"), F.substr(c, at + F.length(first)))
    return F.when(has | (at == 0), c).otherwise(split)


def missing_titles(titles: Column) -> Column:
    """The top-level titles that no heading has, white space aside."""
    return F.filter(F.array(*[F.lit(t) for t in TOP_TITLES]), lambda want: ~F.exists(titles, lambda t: F.contains(compact(t), compact(want))))


def without_noise(c: Column) -> Column:
    """Lines that are nothing but a turn-over or end mark go."""
    kept = F.filter(lines_of(c), lambda x: ~F.regexp_replace(x, "[^0-9A-Za-z가-힣]", "").isin(*NOISE))
    return F.array_join(kept, "\n")


def without_empty_sections(c: Column) -> Column:
    """Sections (a heading and what follows up to the next) whose title or body says that nothing applies go; page markers in them stay."""
    heading = r"(?U)^\s*#{1,6}\s+.*"

    def parted(lines: Column) -> Column:
        """The lines from each heading up to the next; what stands before the first is a part, too."""
        heads = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(heading), i)), lambda i: i.isNotNull())
        starts = F.array_distinct(F.concat(F.array(F.lit(0)), heads))
        return once(starts, lambda at: F.transform(at, lambda b, j: F.slice(lines, b + 1, F.coalesce(F.get(at, j + 1), F.size(lines)) - b)))

    parts = once(lines_of(c), parted)

    def kept(part: Column) -> Column:
        title = compact(F.regexp_extract(F.element_at(part, 1), r"(?U)^\s*#{1,6}\s+(.*)", 1))
        body = compact(F.array_join(F.slice(part, F.lit(2), F.greatest(F.size(part) - 1, F.lit(0))), ""))
        empty = F.lit(False)
        for phrase in NO_CONTENT:
            empty = empty | F.contains(title, F.lit(phrase)) | F.contains(body, F.lit(phrase))
        gone = (F.size(part) > 0) & F.coalesce(F.try_element_at(part, F.lit(1)), F.lit("")).rlike(heading) & empty
        return F.when(gone, F.filter(part, lambda x: x.rlike(r"(?U)^\s*<!--\s*페이지번호:.*-->"))).otherwise(part)

    return F.array_join(F.flatten(F.transform(F.filter(parts, lambda p: F.size(p) > 0), kept)), "\n")


def context_window(c: Column, target: Column, n: int) -> Column:
    """struct<before, after>: n tokens on either side of the first token that is {{target}}; empty if none is."""
    tokens = F.filter(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?s)<!--.*?-->", " "), r"(?U)\s+"), lambda t: t != "")
    at = F.coalesce(F.array_position(tokens, F.concat(F.lit("{{"), target, F.lit("}}"))).cast("int"), F.lit(0))
    low = F.greatest(at - n, F.lit(1))
    before = F.when(at > 1, F.array_join(F.slice(tokens, low, F.greatest(at - low, F.lit(0))), " ")).otherwise("")
    after = F.when(at > 0, F.array_join(F.slice(tokens, F.greatest(at + 1, F.lit(1)), F.lit(n)), " ")).otherwise("")
    return F.struct(before.alias("before"), after.alias("after"))


def ratio(value: float) -> float:
    """A share from a share or a percentage."""
    return min(1.0, max(0.0, value / 100 if value > 1 else value))


def is_numeric_cell(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(c, r"(?U)[\s,]", "").rlike(r"^[0-9.+/%\-]+\z"), F.lit(False))


def has_protected(texts: Column) -> Column:
    return F.coalesce(F.exists(texts, lambda t: compact(t).rlike("|".join(PROTECTED))), F.lit(False))


def clean_response(c: Column) -> Column:
    """A model's answer without code fences and tabs."""
    bare = F.regexp_replace(F.regexp_replace(stripped(c), r"(?im)^```(?:json)?", ""), r"(?m)```$", "")
    return stripped(F.replace(bare, F.lit("\t"), F.lit("")))


def without_trailing_commas(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U),\s*\]", "]"), r"(?U),\s*\}", "}")


#: Scripts and signs that an answer must not have, and letters spaced out.
FOREIGN = r"[\u4e00-\u9fff\u0400-\u04FF\u0600-\u06FF\u2070-\u209F]"
SPACED = r"(?U)(?:[A-Za-z가-힣]\s+){4,}[A-Za-z가-힣]"
LONG_CJK = r"[\u4e00-\u9fff]{8,}"


def is_bad_sentence(c: Column) -> Column:
    s = stripped(F.coalesce(c, F.lit("")))
    return (s == "") | s.rlike(FOREIGN) | s.rlike(SPACED)


def good_sentences(c: Column) -> Column:
    return F.filter(c, lambda s: s.isNotNull() & ~is_bad_sentence(s))


def needs_another_try(summary: Column, family: str) -> Column:
    """For images: spaced letters, raised digits, foreign scripts, or a summary under 60 characters."""
    s = stripped(F.coalesce(summary, F.lit("")))
    weak = s.rlike(SPACED) | s.rlike(r"[\u2070-\u209F\u4e00-\u9fffА-Яа-яЁё\u0600-\u06FF]")
    return weak | (F.length(s) < 60) if family == "images_sum" else weak if family == "images_trans" else F.lit(False)


def prefix(filename: Column, section_path: Column) -> Column:
    name, path = prefix_name(filename), F.coalesce(section_path, F.lit(""))
    said = F.concat_ws(" ", F.when(name != "", F.concat(F.lit("[문서: "), name, F.lit("]"))), F.when(path != "", F.concat(F.lit("[경로: "), path, F.lit("]"))))
    return said


def prefixed(before: Column, text: Column) -> Column:
    return F.when(before != "", stripped(F.concat(before, F.lit(" "), text))).otherwise(text)


def joined_summary(parts: Column) -> Column:
    """Sentences one after another; nothing if they hold a long run of ideographs."""
    text = stripped(F.array_join(F.coalesce(parts, F.array().cast("array<string>")), ""))
    return F.when(text.rlike(LONG_CJK), "").otherwise(text)
