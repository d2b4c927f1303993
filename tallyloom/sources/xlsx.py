"""Spreadsheets (XLSX) as rows, read where the files' bytes are; no library beyond the standard one."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import rename_headers

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
ROWS = "path string, sheet string, row int, cells array<string>"


def _text(node: ElementTree.Element | None) -> str:
    """All text of a shared or inline string, phonetic runs left out."""
    if node is None:
        return ""
    return "".join(t.text or "" for part in node if part.tag in (f"{_MAIN}t", f"{_MAIN}r") for t in ([part] if part.tag == f"{_MAIN}t" else part.iter(f"{_MAIN}t")))


def _column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def sheets(data: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row from 1, cells as text) of a workbook; empty cells are null, rows without cells are left out."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = [_text(s) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        for sheet in book.iter(f"{_MAIN}sheet"):
            target = targets[sheet.get(f"{_REL}id")].lstrip("/")
            target = target if target.startswith("xl/") else f"xl/{target}"
            with z.open(target) as f:
                for _, row in ElementTree.iterparse(f):
                    if row.tag != f"{_MAIN}row":
                        continue
                    cells: list[str | None] = []
                    for k, c in enumerate(row.iter(f"{_MAIN}c")):
                        at = _column(c.get("r")) if c.get("r") else k
                        cells += [None] * (at + 1 - len(cells))
                        value = c.find(f"{_MAIN}v")
                        if c.get("t") == "inlineStr":
                            cells[at] = _text(c.find(f"{_MAIN}is"))
                        elif value is not None and value.text is not None:
                            cells[at] = shared[int(value.text)] if c.get("t") == "s" else value.text
                    if any(x not in (None, "") for x in cells):
                        yield sheet.get("name"), int(row.get("r")), cells
                    row.clear()  # rows that were read are not kept


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows of all sheets of the files of a path: one task a file, whatever store it lies in."""

    def run(batches):
        import pandas as pd

        for files in batches:
            for name, data in zip(files["path"], files["content"]):
                rows = [(name, *r) for r in sheets(data)]
                yield pd.DataFrame(rows, columns=["path", "sheet", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, ROWS)


def read_report(spark: SparkSession, path: str, sheet: str, aliases: dict[str, set[str]], required: set[str]) -> tuple[DataFrame, list[str]]:
    """One sheet whose first row is its header, with the headers mapped to fields as for CSV reports."""
    rows = read_rows(spark, path).where(F.col("sheet") == sheet)
    head = rows.orderBy("row").limit(1).first()
    if head is None:
        raise ValueError(f"no sheet {sheet}")
    found, unknown = rename_headers([f"{i}\x00{c or ''}" for i, c in enumerate(head["cells"])], aliases)
    if missing := required - set(found.values()):
        raise ValueError(f"missing fields: {sorted(missing)}")
    out = rows.where(F.col("row") > head["row"]).select(*[F.get("cells", int(c.split("\x00")[0])).alias(f) for c, f in found.items()])
    return out, [c.split("\x00")[1] for c in unknown if c.split("\x00")[1]]
