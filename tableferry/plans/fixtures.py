"""Input files and workbooks that Spark derives from the tables, for the queries."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.functions.text import quoted
from tableferry.session import fresh_path

CHUNK = 1000  # rows per JSON document or workbook


def csv_folder(df: DataFrame, null: str = "") -> str:
    """Write a frame as comma-separated files with a header."""
    path = fresh_path(df.sparkSession, "csv")
    df.write.csv(
        path,
        header=True,
        escape='"',
        nullValue=null,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def headed_lines(lines: DataFrame, header: str) -> str:
    """Write each partition's texts as they are, as a file under a header."""

    def headed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [header]})
        for batch in batches:
            yield batch.set_axis(["value"], axis=1)

    path = fresh_path(lines.sparkSession, "csv")
    lines.mapInPandas(headed, "value string").write.text(path)
    return path


def json_arrays(df: DataFrame) -> str:
    """Write each partition as a file that holds one array of objects."""

    def bracketed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = "["
        for batch in batches:
            objects = batch["value"]
            if len(objects):
                yield pd.DataFrame({"value": [lead + objects.iloc[0], *("," + objects.iloc[1:])]})
                lead = ","
        yield pd.DataFrame({"value": ["[]" if lead == "[" else "]"]})

    path = fresh_path(df.sparkSession, "json")
    objects = df.select(F.to_json(F.struct("*")).alias("value"))
    objects.mapInPandas(bracketed, "value string").write.text(path)
    return path


def json_column_files(df: DataFrame, key: Column) -> str:
    """Write files that hold one object of columns each, a chunk of rows per file."""
    path = fresh_path(df.sparkSession, "json")
    label = key.cast("string")

    def column(name: str) -> Column:
        entries = F.collect_list(F.struct(label, quoted(name)))
        return F.map_from_entries(entries).alias(name)

    chunks = df.groupBy(F.floor(key / CHUNK).alias("chunk")).agg(*[column(c) for c in df.columns])
    documents = chunks.select(F.to_json(F.struct(*map(quoted, df.columns))).alias("value"))
    documents.write.option("maxRecordsPerFile", 1).text(path)
    return path


_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def workbook_bytes(rows: pd.DataFrame) -> bytes:
    """A minimal workbook with one sheet: a row of titles, then the rows."""

    def cell(value: object) -> str:
        if value is None or value != value:
            return "<c/>"
        if isinstance(value, str):
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
        return f"<c><v>{value!r}</v></c>"

    lines = [rows.columns, *rows.astype(object).itertuples(index=False)]
    body = "".join(f"<row>{''.join(cell(v) for v in line)}</row>" for line in lines)
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>'
        '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}"><Relationship '
        f'Id="rId1" Type="{_OFFICE}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData>'
        "</worksheet>",
    }
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return content.getvalue()


def workbooks(df: DataFrame, key: Column) -> DataFrame:
    """Workbooks as ``path`` and ``content``, a chunk of rows each."""
    names = df.columns

    def pack(chunk: pd.DataFrame) -> pd.DataFrame:
        path = f"book-{chunk['chunk'].iloc[0]}.xlsx"
        return pd.DataFrame({"path": [path], "content": [workbook_bytes(chunk[names])]})

    chunked = df.withColumn("chunk", F.floor(key / CHUNK))
    return chunked.groupBy("chunk").applyInPandas(pack, "path string, content binary")
