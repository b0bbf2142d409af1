"""Report files derived from the tables, written by the tasks that hold the rows."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame


def preamble_lines(df: DataFrame, preamble: list[str]) -> DataFrame:
    """One ``value`` column: per task the preamble, a header line, then its rows as CSV."""
    header = ",".join(df.columns)

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [*preamble, header]})
        for batch in batches:
            yield pd.DataFrame({"value": batch.to_csv(index=False, header=False).splitlines()})

    return df.mapInPandas(lines, "value string")


def workbook(sheets: dict[str, list[list]]) -> bytes:
    """A small workbook with inline texts."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    listed = links = ""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        for n, (name, rows) in enumerate(sheets.items(), 1):
            listed += f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>'
            links += f'<Relationship Id="rId{n}" Type="{rel}/worksheet" Target="worksheets/sheet{n}.xml"/>'
            body = "".join(
                "<row>"
                + "".join(
                    [
                        "<c/>" if cell is None else f'<c t="inlineStr"><is><t>{escape(str(cell))}</t></is></c>'
                        for cell in row
                    ]
                )
                + "</row>"
                for row in rows
            )
            book.writestr(
                f"xl/worksheets/sheet{n}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>"
            )
        book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}">{links}</Relationships>')
    return out.getvalue()


def _cells(column: pd.Series) -> list:
    """Values of a column, None where there is none."""
    lost = column.isna()
    if lost.all():
        return [None] * len(column)
    return column.astype(object).where(~lost, None).tolist()


def workbooks(df: DataFrame, preamble: list[list], sheet: str) -> DataFrame:
    """(path, content): one workbook per Arrow batch of rows, with a second, other sheet."""
    header = list(df.columns)
    key = header[0]

    def books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows = zip(*[_cells(batch[name]) for name in header], strict=True)
                content = workbook({"Ringkasan": [["lain"]], sheet: [*preamble, header, *rows]})
                yield pd.DataFrame({"path": [f"book-{batch[key].iloc[0]}.xlsx"], "content": [content]})

    return df.mapInPandas(books, "path string, content binary")


def sheet_books(df: DataFrame, sheets: dict[str, tuple[list[list], list[str]]], more: dict[str, list[list]]) -> DataFrame:
    """(path, content): per Arrow batch one workbook; each of ``sheets`` has rows before the header and the columns it shows.

    ``more`` are sheets of their own, after the others.
    """

    def books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows = batch.astype(object).where(batch.notna(), None)
                content = workbook(
                    {name: [*before, shown, *rows[shown].values.tolist()] for name, (before, shown) in sheets.items()} | more
                )
                yield pd.DataFrame({"path": [f"book-{batch.iloc[0, 0]}.xlsx"], "content": [content]})

    return df.mapInPandas(books, "path string, content binary")
