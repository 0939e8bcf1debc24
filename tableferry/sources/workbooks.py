"""Folders of .xlsx workbooks, one task per workbook.

A sheet holds at most 1,048,576 rows, so a workbook fits in a task. Only the
cell texts leave the reader; titles, missing values and types are worked out on
the frame.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.text import NA_TOKENS, na_as_null, quoted
from tableferry.functions.types import cast_text, text_types
from tableferry.sources.files import name_columns
from tableferry.sources.relation import materialize

_BATCH = 20_000
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# The number formats of the file format that show a date or a time.
_DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_DATE_MARK = "\u0001"  # leads the text of a date cell until the types are known


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _texts(node: ElementTree.Element) -> str:
    """The text runs of a node, phonetic hints left out."""
    if _local(node.tag) == "rPh":
        return ""
    own = (node.text or "") if _local(node.tag) == "t" else ""
    return own + "".join(_texts(child) for child in node)


def _tree(book: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, bool]:
    """The part that holds the first sheet, and whether dates count from 1904."""
    workbook = _tree(book, "xl/workbook.xml")
    relations = _tree(book, "xl/_rels/workbook.xml.rels")
    sheet = next(n for n in workbook.iter() if _local(n.tag) == "sheet")
    target = next(r.get("Target") for r in relations if r.get("Id") == sheet.get(_REL))
    from_1904 = any(
        _local(n.tag) == "workbookPr" and n.get("date1904") in ("1", "true")
        for n in workbook.iter()
    )
    return posixpath.normpath(posixpath.join("/xl", target)).lstrip("/"), from_1904


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """The cell styles that show a date or a time."""
    styles = _tree(book, "xl/styles.xml")
    if styles is None:
        return set()
    custom = {
        int(n.get("numFmtId")): n.get("formatCode", "")
        for n in styles.iter()
        if _local(n.tag) == "numFmt"
    }

    def shows_date(format_id: int) -> bool:
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get(format_id, ""))
        return format_id in _DATE_FORMATS or bool(re.search(r"[dmyhs]", code, re.IGNORECASE))

    formats = next((n for n in styles if _local(n.tag) == "cellXfs"), ())
    return {i for i, xf in enumerate(formats) if shows_date(int(xf.get("numFmtId", "0")))}


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _number_text(text: str, is_date: bool, from_1904: bool) -> str:
    value = float(text)
    if is_date:
        # Day 60 of the 1900 count is a 29 February that never was.
        epoch = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30 if value >= 60 else 31)
        return _DATE_MARK + str(epoch + timedelta(milliseconds=round(value * 86_400_000)))
    return str(int(value)) if value.is_integer() and abs(value) < 2**53 else repr(value)


def _sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """The rows of the first sheet as cell texts."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part, from_1904 = _first_sheet(book)
        shared = _tree(book, "xl/sharedStrings.xml")
        strings = [_texts(item) for item in shared] if shared is not None else []
        dates = _date_styles(book)
        with book.open(part) as stream:
            for _, node in ElementTree.iterparse(stream):
                if _local(node.tag) != "row":
                    continue
                cells: list[str | None] = []
                for cell in node:
                    at = _column_index(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend([None] * (at + 1 - len(cells)))
                    cells[at] = _cell_text(cell, strings, dates, from_1904)
                yield cells
                node.clear()


def _cell_text(
    cell: ElementTree.Element, strings: list[str], dates: set[int], from_1904: bool
) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(_texts(n) for n in cell)
    value = next((n.text for n in cell if _local(n.tag) == "v"), None)
    if value is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "n":
        return _number_text(value, int(cell.get("s", "0")) in dates, from_1904)
    return value


def _read_workbooks(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = _sheet_rows(content)
            header = next(rows, [])
            titles = name_columns(header)
            chunk: list[tuple[str, int, dict[str, str | None]]] = []
            for number, cells in enumerate(rows):
                if any(c is not None for c in cells):
                    cells = cells + [None] * (len(titles) - len(cells))
                    if len(cells) > len(titles):
                        raise ValueError(f"{path}: row {number + 2} has more cells than titles")
                    chunk.append((path, number, dict(zip(titles, cells))))
                if len(chunk) == _BATCH:
                    yield pd.DataFrame(chunk, columns=["path", "row", "cells"])
                    chunk = []
            if chunk:
                yield pd.DataFrame(chunk, columns=["path", "row", "cells"])


def read_excel(
    spark: SparkSession,
    path: str | list[str],
    infer: bool = True,
    na_tokens: Iterable[str] = NA_TOKENS,
) -> DataFrame:
    """Read the first sheet of every workbook; columns are matched by title."""
    books = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return parse_workbooks(books, infer, na_tokens)


def parse_workbooks(
    books: DataFrame, infer: bool = True, na_tokens: Iterable[str] = NA_TOKENS
) -> DataFrame:
    """The rows of workbooks given as ``path`` and ``content``.

    Unpacking is the dear part, so the cells are stored once and read from there.
    """
    rows = materialize(
        books.select("path", "content").mapInPandas(
            _read_workbooks, "path string, row bigint, cells map<string,string>"
        )
    )
    # A schema has to be known to the driver: one entry per title, in sheet order.
    titles = (
        rows.select(F.posexplode(F.map_keys("cells")).alias("place", "title"))
        .groupBy("title")
        .agg(F.min("place").alias("place"))
        .orderBy("place", "title")
        .collect()
    )
    names = [r["title"] for r in titles]
    df = rows.select([F.col("cells")[n].alias(n) for n in names])
    dated = _date_columns(df)
    plain = df.select([F.translate(quoted(n), _DATE_MARK, "").alias(n) for n in names])
    dates = plain.withColumns({n: quoted(n).try_cast("timestamp_ntz") for n in dated})
    cells = na_as_null(dates, na_tokens)
    return cast_text(cells, text_types(cells)) if infer else cells


def _date_columns(df: DataFrame) -> set[str]:
    """The columns whose cells are all dates."""
    if not df.columns:
        return set()
    row = df.agg(
        *[
            F.every(F.startswith(quoted(c), F.lit(_DATE_MARK))).alias(f"d{i}")
            for i, c in enumerate(df.columns)
        ]
    ).first()
    return {c for i, c in enumerate(df.columns) if row[f"d{i}"]}
