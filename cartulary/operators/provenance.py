"""Documents with provenance: parsed blocks and table cells as elements with stable ids, evidence anchored to them."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.functions.text import norm_quote, strip

# What a heading looks like, and how long it may be.
HEADING = r"^(제?\s*\d+[\.\)]|[0-9]+\.|[가-힣A-Za-z]{1,20}\s*$)"
HEADING_CHARS = 40
BLOCKS = "path string, document_sha256 string, page int, x0 double, y0 double, x1 double, y1 double, raw string"


def looks_like_heading(raw: Column) -> Column:
    """one short line that begins with a number or is one word."""
    t = strip(F.coalesce(raw, F.lit("")))
    return (F.length(t) <= HEADING_CHARS) & ~F.contains(t, F.lit("\n")) & F.regexp_like(t, F.lit(f"(?U){HEADING}"))


def bbox_envelope(points: Column) -> Column:
    """struct(x0, y0, x1, y1) around an array of points (arrays of x and y); null without a whole point."""
    whole = F.filter(points, lambda p: F.size(p) >= 2)
    x, y = F.transform(whole, lambda p: p[0].cast("double")), F.transform(whole, lambda p: p[1].cast("double"))
    box = F.struct(F.array_min(x).alias("x0"), F.array_min(y).alias("y0"), F.array_max(x).alias("x1"), F.array_max(y).alias("y1"))
    return F.when((F.size(whole) > 0) & (F.size(whole) == F.size(points)), box)


def block_elements(blocks: DataFrame) -> DataFrame:
    """(document_sha256, page, element_id, index, x0, y0, x1, y1, text, modality, section_path) of text blocks.

    Blank blocks go; the rest of a page are numbered from the top, then from the left (places to a tenth); blocks that
    normalising empties go after that, so numbers may have gaps. A section is the last heading of the page so far."""
    place = [F.round("y0", 1), F.round("x0", 1), F.col("y0"), F.col("x0"), F.xxhash64("raw")]
    page = Window.partitionBy("document_sha256", "page")
    rows = blocks.where(strip(F.coalesce("raw", F.lit(""))) != "").withColumn("index", F.row_number().over(page.orderBy(*place)) - 1)
    rows = rows.withColumn("text", norm_quote(F.col("raw"))).where("text <> ''")
    section = F.last(F.when(looks_like_heading(F.col("raw")), F.col("text")), True).over(page.orderBy("index").rowsBetween(Window.unboundedPreceding, 0))
    name = F.concat(F.lit("p"), "page", F.lit("-b"), "index")
    return rows.select("document_sha256", "page", name.alias("element_id"), "index", "x0", "y0", "x1", "y1", "text", F.lit("text").alias("modality"), section.alias("section_path"))


def cell_elements(tables: DataFrame) -> DataFrame:
    """The same columns for tables (document_sha256, page, table, x0, y0, x1, y1, rows: an array of arrays of text):
    an element for each cell with text, under the last section of its page if that is a column."""
    rows = tables.select("*", F.posexplode("rows").alias("r", "cells")).select("*", F.posexplode("cells").alias("c", "cell"))
    name = F.concat(F.lit("p"), "page", F.lit("-table"), "table", F.lit("-r"), "r", F.lit("-c"), "c")
    section = F.col("section_path") if "section_path" in tables.columns else F.lit(None).cast("string")
    out = rows.select("document_sha256", "page", name.alias("element_id"), F.col("table").alias("index"), "x0", "y0", "x1", "y1", norm_quote(F.col("cell")).alias("text"), F.lit("table").alias("modality"), section.alias("section_path"))
    return out.where("text <> ''")


def build_evidence(elements: DataFrame, quotes: DataFrame) -> DataFrame:
    """(qa_id, evidence item) of quotes (qa_id, document_sha256, document_version, element_id, quote); a quote that
    its element doesn't hold is an error."""
    rows = quotes.join(elements.select("document_sha256", "element_id", "page", "x0", "y0", "x1", "y1", "text", "modality", "section_path"), ["document_sha256", "element_id"], "left")
    rows = rows.withColumn("quote", norm_quote(F.col("quote")))
    there = F.coalesce(F.contains("text", "quote"), F.lit(False))
    miss = F.raise_error(F.concat(F.lit("quote not found verbatim in element "), "element_id")).cast("boolean")
    rows = rows.where(F.when(there, F.lit(True)).otherwise(miss))
    box = F.transform(F.array("x0", "y0", "x1", "y1"), lambda v: F.round(v, 2))
    return rows.select("qa_id", "document_sha256", "document_version", "page", "element_id", box.alias("bbox"), "quote", F.sha2("quote", 256).alias("quote_sha256"), "modality", "section_path")


def extraction_plan(configs: DataFrame) -> DataFrame:
    """Configs (strategy, hi_res_model_name, gpu_boost, gpu_ready) with the effective strategy, whether tables are
    inferred, and whether the GPU is used. A named model or a GPU turns `auto` into hi_res; other strategies stay."""
    model = F.coalesce("hi_res_model_name", F.lit("")) != ""
    gpu = F.coalesce("gpu_boost", F.lit(True)) & F.coalesce("gpu_ready", F.lit(False))
    auto = F.coalesce("strategy", F.lit("auto")) == "auto"
    strategy = F.when(auto & (model | gpu), "hi_res").otherwise(F.coalesce("strategy", F.lit("auto")))
    return configs.withColumns({"effective_strategy": strategy, "infer_table_structure": model | gpu, "gpu_accelerated": gpu})


def pdf_blocks(files: DataFrame, parse: Callable[[bytes], Iterator[tuple]] | None = None) -> DataFrame:
    """A row for each block that a parser (bytes -> (page, x0, y0, x1, y1, raw) each) finds in files (path, content).
    The parser is a plug-in; the one that comes along reads the text that content streams show."""
    parse = parse or plain_pdf_blocks

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for pdf in batches:
            rows = [(path, hashlib.sha256(content).hexdigest(), *block) for path, content in zip(pdf["path"], pdf["content"], strict=True) for block in parse(bytes(content))]
            yield pd.DataFrame(rows, columns=["path", "document_sha256", "page", "x0", "y0", "x1", "y1", "raw"])

    return files.select("path", "content").mapInPandas(run, BLOCKS)


_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_SHOWN = re.compile(rb"(BT|ET|T\*)|(-?[\d.]+)\s+(-?[\d.]+)\s+T[dD]|(?:-?[\d.]+\s+){4}(-?[\d.]+)\s+(-?[\d.]+)\s+Tm|(\[(?:\\.|[^\]])*\])\s*TJ|(\((?:\\.|[^\\)])*\))\s*(?:Tj|'|\")", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _literal(raw: bytes) -> str:
    def one(m: re.Match) -> bytes:
        x = m[1]
        return bytes([int(x, 8) & 255]) if x.isdigit() else _ESCAPES.get(x, x)

    return re.sub(rb"\\([0-7]{1,3}|.)", one, raw, flags=re.S).decode("latin-1")


def plain_pdf_blocks(content: bytes) -> Iterator[tuple]:
    """(page, x0, y0, x1, y1, raw) of the text objects that pages' content streams (plain or deflated) show in simple
    fonts. A file's y runs upwards and is turned here; widths aren't known, so a block is as wide as its place."""
    objects = {int(m[1]): m[3] for m in _OBJECT.finditer(content)}
    number = 0
    for body in [b for b in objects.values() if re.search(rb"/Type\s*/Page\b", b)]:
        number += 1
        box = re.search(rb"/MediaBox\s*\[\s*[-\d.]+\s+[-\d.]+\s+[-\d.]+\s+([-\d.]+)", body)
        height = float(box[1]) if box else 792.0
        for ref in re.findall(rb"(\d+)\s+\d+\s+R", (re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body) or [b"", b""])[1]):
            part = objects.get(int(ref), b"")
            if not (m := _STREAM.search(part)):
                continue
            data = m[1]
            if b"/FlateDecode" in part:
                try:
                    data = zlib.decompressobj().decompress(data)
                except zlib.error:
                    continue
            x = y = 0.0
            lines: list[tuple[float, float, str]] = []
            for op in _SHOWN.finditer(data):
                if op[1] == b"BT":
                    x = y = 0.0
                    lines = []
                elif op[1] == b"ET" and lines:
                    yield number, min(a for a, _, _ in lines), height - max(b for _, b, _ in lines), max(a for a, _, _ in lines), height - min(b for _, b, _ in lines), "\n".join(t for _, _, t in lines)
                elif op[2]:
                    x, y = x + float(op[2]), y + float(op[3])
                elif op[4]:
                    x, y = float(op[4]), float(op[5])
                elif op[6] or op[7]:
                    text = "".join(_literal(t) for t in re.findall(rb"\(((?:\\.|[^\\)])*)\)", op[6], re.S)) if op[6] else _literal(op[7][1:-1])
                    if lines and abs(lines[-1][1] - y) < 0.1:
                        lines[-1] = (lines[-1][0], y, lines[-1][2] + text)
                    else:
                        lines.append((x, y, text))
