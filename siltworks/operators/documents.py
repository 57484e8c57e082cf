"""Documents: section trees, code blocks, links and anchors."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.functions import code, prose

SECTION = "source string, format string, ordinal int, level int, title string, path array<string>, body string"
#: Characters of a section's clean body that make it usable.
MIN_SECTION, MAX_SECTION = 120, 6000

_HEADING = re.compile(r"^(#{1,6})\s+(.+?)\s*#*\s*$")
_ADORNMENT = re.compile(r"^([=\-~^\"'`#*+:._])\1{2,}\s*$")


def _headings(lines: list[str], kind: str) -> Iterator[tuple[int, int, str]]:
    """(line, level, title): ATX headings, or titles over (and under) rows of one punctuation mark, whose levels follow their first appearance."""
    if kind == "md":
        for k, line in enumerate(lines):
            if m := _HEADING.match(line):
                yield k, len(m[1]), m[2].strip()
        return
    levels: dict[str, int] = {}
    rule = lambda k: lines[k].strip() if 0 <= k < len(lines) and _ADORNMENT.match(lines[k].strip()) else None
    for k, line in enumerate(lines):
        if line and line.rstrip() == line and not line[0].isspace() and not _ADORNMENT.match(line) and (below := rule(k + 1)):
            yield k, levels.setdefault(below[0], len(levels)), line


def sections(docs: DataFrame) -> DataFrame:
    """Sections of docs(source, format, text), in order, with the titles above them; text before the first heading has level 0.

    A document without headings is one section. One document is one row of an Arrow batch; the
    heading stack makes it a fold, so it is Python.
    """

    def run(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for source, kind, text in zip(batch["source"], batch["format"], batch["text"], strict=True):
                kept = (text or "").splitlines(keepends=True)
                found = list(_headings([x.rstrip("\r\n") for x in kept], kind))
                if not found:
                    out.append((source, kind, 0, 0, "", [], text or ""))
                    continue
                lead = "".join(kept[: found[0][0]]).strip()
                rows, above = ([(0, "", [], lead)] if lead else []), []
                for (at, level, title), end in zip(found, [*(x[0] for x in found[1:]), len(kept)], strict=True):
                    above = [x for x in above if x[0] < level] if not above or above[-1][0] >= level else above
                    rows.append((level, title, [t for _, t in above] + [title], "".join(kept[at + 1 : end])))
                    above = [*above, (level, title)]
                out += [(source, kind, n, *r) for n, r in enumerate(rows)]
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SECTION.split(", ")])

    return docs.select("source", "format", "text").mapInPandas(run, SECTION)


def usable_sections(found: DataFrame, low: int = MIN_SECTION, high: int = MAX_SECTION) -> DataFrame:
    """Sections with a title path and a clean body of usable length: source, title (joined), clean; the first of equal ones."""
    titles = F.filter("path", lambda t: t != "")
    clean = F.regexp_replace(prose.clean_markdown(F.col("body")), r"^(?:(?:[-=~^_#*+]{3,}|\s)*\n)+", "")
    rows = found.select("source", "format", "level", "ordinal", F.array_join(titles, " > ").alias("title"), F.trim(clean).alias("clean")).where("title <> ''").where(F.length("clean").between(low, high))
    w = Window.partitionBy(F.sha2(F.concat_ws("\0", "title", "clean"), 256)).orderBy("source", "ordinal")
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def code_blocks(docs: DataFrame, text: str = "text", low: int = 30, high: int = 4000) -> DataFrame:
    """Fenced blocks that look like code, of usable length, the first of those equal but for blanks: source, block."""
    rows = docs.select("source", F.posexplode(code.fences(F.col(text))).alias("at", "raw")).withColumn("block", F.regexp_replace("raw", r"^\n+|\n+$", ""))
    rows = rows.where(F.length("block").between(low, high) & code.looks_like_code(F.col("block")))
    w = Window.partitionBy(F.sha2(F.regexp_replace("block", r"\s+", " "), 256)).orderBy("source", "at")
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").select("source", "block")


def page_parts(pages: DataFrame) -> DataFrame:
    """page_id, title, links: what a raw page's markup says."""
    return pages.select("page_id", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1).alias("links"))


def anchors(headings: DataFrame) -> DataFrame:
    """headings(path, seq, title) with their anchor; the n-th repeat of one in a file ends in -n."""
    rows = headings.withColumn("slug", code.slug(F.col("title")))
    n = F.row_number().over(Window.partitionBy("path", "slug").orderBy("seq")) - 1
    return rows.withColumn("anchor", F.when(n == 0, F.col("slug")).otherwise(F.concat_ws("-", "slug", n.cast("string"))))


def link_errors(links: DataFrame, files: DataFrame, found: DataFrame) -> DataFrame:
    """(path, target, error) of links(path, target): targets with blanks, without a file, or without the anchor in an .md file.

    Targets in other schemes and within the page are not judged. files(path), found(path, anchor).
    """
    t = links.where(~F.col("target").rlike(r"^(#|http://|https://|mailto:|ftp://)") & (F.trim("target") != ""))
    t = t.withColumns({"file": F.substring_index("target", "#", 1), "anchor": F.when(F.contains("target", F.lit("#")), F.regexp_extract("target", "#(.*)$", 1))})
    known = files.select(F.col("path").alias("file"), F.lit(True).alias("exists"))
    slugs = found.select(F.col("path").alias("file"), "anchor", F.lit(True).alias("anchored")).distinct()
    j = t.join(known, "file", "left").join(slugs, ["file", "anchor"], "left")
    error = F.when(F.contains("target", F.lit(" ")), "space").when(F.col("exists").isNull(), "missing file").when((F.coalesce("anchor", F.lit("")) != "") & F.col("file").endswith(".md") & F.col("anchored").isNull(), "missing anchor")
    return j.select("path", "target", error.alias("error")).where("error IS NOT NULL")
