"""Jobs on tables of documents: links, structure, logs, page merges, HTML sections."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.dictionaries import (
    INDEX_ENTRY_PATTERN,
    INLINE_CODE_PATTERN,
    LOG_HEADING_PATTERN,
    PAGE_NAME_PATTERN,
    REQUIRED_SECTIONS,
    WIKILINK_PATTERN,
)
from specloom.functions.text import strip
from specloom.operators.html_sections import sections_of
from specloom.operators.ordering import with_position

FINDING = ["severity", "page", "rule", "detail"]
LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85  ]"


def _finding(severity: Column | str, page: Column, rule: str, detail: Column) -> list[Column]:
    level = F.lit(severity) if isinstance(severity, str) else severity
    return [
        level.alias("severity"), page.cast("string").alias("page"), F.lit(rule).alias("rule"),
        detail.cast("string").alias("detail"),
    ]


def _without_mark(text: Column) -> Column:
    return F.when(text.startswith("﻿"), F.substring(text, F.lit(2), F.length(text))).otherwise(text)


def lines(docs: DataFrame) -> DataFrame:
    """``(page, line_no, line)`` of ``(page, text)``, counted from 1."""
    return docs.select("page", F.posexplode(F.split(_without_mark(F.col("text")), LINE_BREAK)).alias("_at", "line")).select(
        "page", (F.col("_at") + 1).alias("line_no"), "line"
    )


def extract_links(docs: DataFrame, pattern: str = WIKILINK_PATTERN, skip_code: bool = True) -> DataFrame:
    """``(page, target)`` of every link in ``(page, text)``; repeats stay."""
    text = F.regexp_replace("text", INLINE_CODE_PATTERN, "") if skip_code else F.col("text")
    return docs.select(
        "page", F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).alias("target")
    ).withColumn("target", strip(F.col("target")))


def resolve_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Findings for links to a page that is missing, or that several pages claim.

    ``pages`` is ``(name, location)``.  Owners are counted, not listed: a name
    may have any number of them (``ambiguous_locations`` gives them as rows).
    """
    owners = pages.groupBy("name").agg(F.count("*").alias("_owners"))
    joined = links.join(owners, links["target"] == owners["name"], "left")
    severity = F.when(F.col("_owners").isNull(), "ERROR").when(F.col("_owners") > 1, "WARN")
    rule = F.when(F.col("_owners").isNull(), "missing page").otherwise("ambiguous page")
    return (
        joined.select(
            severity.alias("severity"), F.col("page").cast("string").alias("page"), rule.alias("rule"),
            F.col("target").alias("detail"), F.coalesce("_owners", F.lit(0)).alias("n_locations"),
        ).filter(F.col("severity").isNotNull())
    )


def ambiguous_locations(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Where the pages are that share a name some link uses, one row each."""
    shared = pages.groupBy("name").agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    used = shared.join(links.select(F.col("target").alias("name")), "name", "left_semi")
    return pages.join(used.select("name"), "name", "left_semi").select(F.col("name").alias("target"), "location")


def missing_refs(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Index entries whose path is not in ``manifest``, a table of ``path``.

    Entries without a slash and web addresses are not paths.
    """
    entry = F.regexp_extract("line", INDEX_ENTRY_PATTERN, 1)
    refs = (
        lines(docs).select("page", entry.alias("candidate"))
        .filter(F.col("candidate").contains("/") | F.col("candidate").contains("\\"))
        .withColumn("path", F.replace("candidate", F.lit("\\"), F.lit("/")))
        .filter(~F.col("path").startswith("http://") & ~F.col("path").startswith("https://"))
    )
    return refs.join(manifest.select("path").distinct(), "path", "left_anti").select(
        *_finding("ERROR", F.col("page"), "missing path", F.col("candidate"))
    )


def structure_findings(
    docs: DataFrame, sections: Sequence[str] = REQUIRED_SECTIONS, keys: Sequence[str] = ()
) -> DataFrame:
    """One finding per rule a page breaks; templates, named ``_...``, are skipped.

    A page starts with front matter, which has the ``keys``, and holds the
    sections.
    """
    text = F.col("_text")

    def broken(when: Column, severity: str, detail: str) -> Column:
        return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(detail).alias("detail")))

    front = F.regexp_extract(text, r"\A---\n((?s:.*?))(?:\n---|\z)", 1)
    rules = [broken(~text.startswith("---\n"), "ERROR", "front matter")]
    rules += [broken(~text.contains(f"## {s}"), "WARN", s) for s in sections]
    rules += [
        broken(text.startswith("---\n") & ~front.rlike(rf"(?m)^{k}\s*:"), "ERROR", f"front matter key {k}") for k in keys
    ]
    pages = docs.filter(~F.regexp_extract("page", r"([^/]*)$", 1).startswith("_"))
    return pages.withColumn("_text", _without_mark(F.coalesce("text", F.lit("")))).select(
        "page", F.inline(F.array_compact(F.array(*rules)))
    ).select(*_finding(F.col("severity"), F.col("page"), "structure", F.col("detail")))


def heading_findings(docs: DataFrame, pattern: str = LOG_HEADING_PATTERN) -> DataFrame:
    """Second-level headings that do not have the log format, with their line."""
    wrong = lines(docs).filter(F.col("line").startswith("## ") & ~F.col("line").rlike(pattern))
    return wrong.select(*_finding("WARN", F.col("page"), "heading", F.concat_ws(": ", "line_no", "line")))


def parse_log(docs: DataFrame) -> DataFrame:
    """Log entries: date, kind, title and number of bullets.

    A text is split at its headings inside its row, so lines are neither
    moved nor ordered.
    """
    head = r"\A## \[(\d{4}-\d{2}-\d{2})\] (ingest|query|lint) \| ([^\n]+)"
    entries = docs.select(
        "page", F.posexplode(F.split(_without_mark(F.col("text")), r"(?m)^(?=## )")).alias("entry_no", "entry")
    ).filter(F.col("entry").rlike(head))
    return entries.select(
        "page", "entry_no",
        F.to_date(F.regexp_extract("entry", head, 1)).alias("day"),
        F.regexp_extract("entry", head, 2).alias("kind"),
        F.regexp_extract("entry", head, 3).alias("title"),
        F.size(F.regexp_extract_all("entry", F.lit(r"(?m)^- "), F.lit(0))).alias("n_bullets"),
    )


def log_timeline(entries: DataFrame) -> DataFrame:
    return entries.groupBy("day", "kind").agg(
        F.count("*").alias("n"), F.sum("n_bullets").alias("n_bullets")
    )


def lint_report(findings: Sequence[DataFrame]) -> DataFrame:
    """All findings of all checks."""
    return reduce(DataFrame.unionByName, [f.select(*FINDING) for f in findings])


def lint_summary(report: DataFrame) -> DataFrame:
    """Findings per severity; the check fails if there is an error."""
    return report.groupBy("severity").agg(
        F.count("*").alias("n"), F.bool_or(F.col("severity") == "ERROR").alias("failed")
    )


def missing_members(required: DataFrame, manifest: DataFrame, key: str = "path") -> DataFrame:
    """Required members the manifest does not list."""
    return required.join(manifest.select(key).distinct(), key, "left_anti")


def page_findings(pages: DataFrame) -> DataFrame:
    """Pages of ``(doc, name, text)`` that cannot be merged: no number, or no content."""
    number = F.regexp_extract("name", PAGE_NAME_PATTERN, 1)
    reason = F.when(F.coalesce(number, F.lit("")) == "", "page number").when(
        F.coalesce(strip(F.col("text")), F.lit("")) == "", "empty page"
    )
    return pages.select(
        *_finding("ERROR", F.concat_ws("/", F.col("doc").cast("string"), "name"), "merge", reason)
    ).filter(F.col("detail").isNotNull())


def merge_parts(pages: DataFrame) -> DataFrame:
    """The pages of each document as its parts in order, each with its page heading.

    One row per page that can be merged, at every size, by page number, then
    text; pages of a NULL document belong together, and pages of equal names
    each keep their part.
    """
    content = strip(F.col("text"))
    page_no = F.regexp_extract("name", PAGE_NAME_PATTERN, 1)
    usable = pages.filter((page_no != "") & (content != "")).withColumn("_no", page_no.cast("bigint"))
    digits = F.col("_no").cast("string")
    shown = F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits)
    part = F.concat(F.lit("<!-- source: "), "name", F.lit(" -->\n## Page "), shown, F.lit("\n\n"), content)
    rows = usable.select("doc", "_no", part.alias("text"))
    placed = with_position(rows, ["doc"], [F.col("_no").asc(), F.col("text").asc()], "part_no")
    return placed.select("doc", "part_no", "text")


def merge_pages(pages: DataFrame) -> DataFrame:
    """Each document as one text, for those who want it whole: a row holds all its pages.

    ``merge_parts`` gives the same without gathering a document.
    """
    parts = F.array_sort(F.collect_list(F.struct("part_no", "text")))
    text = F.array_join(F.transform(parts, lambda p: p["text"]), "\n\n---\n\n")
    return merge_parts(pages).groupBy("doc").agg(
        F.count("*").alias("n_pages"), F.concat(text, F.lit("\n")).alias("text")
    )


SECTION = (
    "section_no int, title string, eyebrow string, lead string, meta string, bullets array<string>, "
    "cards array<struct<badge:string,title:string,body:string>>, tables array<array<array<string>>>, "
    "paragraphs array<string>"
)


_TEXTS = pa.list_(pa.string())
_SECTION_FIELDS = [
    pa.field("section_no", pa.int32()), *[pa.field(name, pa.string()) for name in ("title", "eyebrow", "lead", "meta")],
    pa.field("bullets", _TEXTS), pa.field("cards", pa.list_(pa.struct([(n, pa.string()) for n in ("badge", "title", "body")]))),
    pa.field("tables", pa.list_(pa.list_(_TEXTS))), pa.field("paragraphs", _TEXTS),
]
#: Pages that are sections in a Python worker's memory at a time.
PAGES_AT_ONCE = 64


def extract_sections(pages: DataFrame, section: tuple[str, str] | None = ("section", "slide")) -> DataFrame:
    """The parts of each section of ``(page, html)`` as nested columns.

    ``section`` is the tag and class of a section; without one the whole page
    is a section.  Only the page id and the HTML go to Python, where a few pages at a time
    become rows, so that memory does not grow with the rows of a batch.
    """
    kind = dict(pages.dtypes)["page"]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                some = batch.slice(at, PAGES_AT_ONCE)
                origin, rows = [], []
                for i, html in enumerate(some.column("html")):
                    for found in sections_of(html.as_py(), section):
                        origin.append(i)
                        rows.append(found)
                columns = list(zip(*rows)) if rows else [[] for _ in _SECTION_FIELDS]
                yield pa.RecordBatch.from_arrays(
                    [some.column("page").take(pa.array(origin, pa.int64()))]
                    + [pa.array(c, f.type) for c, f in zip(columns, _SECTION_FIELDS)],
                    names=["page", *[f.name for f in _SECTION_FIELDS]],
                )

    return pages.select("page", "html").mapInArrow(extract, f"page {kind}, {SECTION}")


def orphan_pages(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages no link leads to."""
    return pages.join(links.select(F.col("target").alias("name")).distinct(), "name", "left_anti")


def one_way_links(links: DataFrame) -> DataFrame:
    """Pairs of names where the first links to the second but not back."""
    pairs = links.select("source", "target").distinct()
    back = pairs.select(F.col("target").alias("source"), F.col("source").alias("target"))
    return pairs.join(back, ["source", "target"], "left_anti")
