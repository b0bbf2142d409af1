"""Spreadsheet workbooks as grids.

Workbooks are read as binary files, many per task, and each is streamed through
the standard library's zip and XML readers. The format itself bounds a sheet to
1,048,576 rows; rows leave in batches, so no sheet is held whole.

``sheet_rows`` takes several tables from one parse of a file: each by a rule
that says where its sheet, header, data and period cell are and which columns
are wanted. Only the wanted cells leave the task.
"""

from __future__ import annotations

import codecs
import datetime as dt
import functools
import io
import itertools
import re
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 4096
GRID_SCHEMA = "path string, sheet string, row_no bigint, cells array<string>"
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Fixed values of the format: built-in number formats of dates and times, marks of date codes, and what is none.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_DATE_MARK = re.compile("[ymdhs]", re.IGNORECASE)
#: Rows and cells as programs write them, the entities of a text, and characters that XML 1.0 has not.
_ROW_BEGIN = re.compile(r'<row(?: r="([0-9]+)")?(?: (?:spans|s|customFormat|ht|customHeight|hidden)="[0-9a-z:. ]*")* ?(/?)>')
_CELL = re.compile(
    r'(?: r="([A-Z]{1,3})[0-9]+")?(?: s="([0-9]+)")?(?: t="([A-Za-z]+)")?(?: s="([0-9]+)")? ?'
    r'(?:/>|>(?:<is><t(?: xml:space="preserve")?>([^<]*+)</t></is>|<v>([^<]*+)</v>)?</c>)'
)
_INLINE, _INLINE_END = ' t="inlineStr"><is><t>', "</t></is></c>"
_ENTITIES = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}
_ENTITY = re.compile("&(?:(lt|gt|amp|quot|apos)|#(9|10|13|3[2-9]|[4-9][0-9]));")
_NO_TEXT = bytes({*range(32)} - {9, 10, 13})
_NO_DATE_MARK = re.compile(r'"[^"]*"|\\.|_.|\[(?![hms]+\])[^\]]*\]|general', re.IGNORECASE)


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


@functools.cache
def _place_of(letters: str) -> int:
    """The same of letters alone, so that few are kept."""
    return _column_index(letters)


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    texts = []
    for _, node in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
        if node.tag == f"{_MAIN}si":
            texts.append(_plain_text(node))
            node.clear()
    return texts


def _plain_text(node: ElementTree.Element) -> str:
    """Text of a string item: its own and that of its runs, not its phonetic guides."""
    parts = [node.findtext(f"{_MAIN}t") or ""]
    parts += [run.findtext(f"{_MAIN}t") or "" for run in node.iter(f"{_MAIN}r")]
    return "".join(parts)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell styles that show a number as a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    styles = ElementTree.fromstring(book.read("xl/styles.xml"))
    codes = {int(f.get("numFmtId")): f.get("formatCode") or "" for f in styles.iter(f"{_MAIN}numFmt")}
    own = {n for n, code in codes.items() if _DATE_MARK.search(_NO_DATE_MARK.sub("", code))}
    cells = styles.find(f"{_MAIN}cellXfs")
    formats = [int(x.get("numFmtId") or 0) for x in cells] if cells is not None else []
    return {i for i, n in enumerate(formats) if n in own or (n in _DATE_FORMATS and n not in codes)}


def _counts_from_1904(book: zipfile.ZipFile) -> bool:
    settings = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}workbookPr")
    return settings is not None and settings.get("date1904") in ("1", "true")


def _date_text(value: str, from_1904: bool) -> str:
    """ISO text of a day number; a number below one is a time of day, no date's number stays as it is."""
    try:
        number = float(value)
        seconds = round(number * 86400)
        if 0 <= number < 1:
            return str(dt.time(seconds // 3600 % 24, seconds // 60 % 60, seconds % 60))
        # The 1900 calendar counts a 29th of February that was none: days before it are one ahead.
        start = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 31 if number < 60 else 30)
        moment = start + dt.timedelta(seconds=seconds)
    except (ValueError, OverflowError):
        return value
    return str(moment) if seconds % 86400 else str(moment.date())


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in links}
    listed = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
    return [(s.get("name"), "xl/" + target[s.get(_REL)].removeprefix("/xl/")) for s in listed]


def _cell_text(cell: ElementTree.Element, shared: list[str], dates: set[int], from_1904: bool) -> str | None:
    if cell.get("t") == "inlineStr":
        return "".join(_plain_text(x) for x in cell.iter(f"{_MAIN}is"))
    value = cell.findtext(f"{_MAIN}v")
    return _value_text(cell.get("t", "n"), cell.get("s"), value, shared, dates, from_1904)


def _value_text(
    kind: str, style: str | None, value: str | None, shared: list[str], dates: set[int], from_1904: bool
) -> str | None:
    if value is None or kind == "e":
        return None
    if kind == "d":
        return value.replace("T", " ")
    if kind == "n" and int(style or 0) in dates:
        return _date_text(value, from_1904)
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    return value


class _OddSheetError(Exception):
    """A sheet is written in a way that only the XML reader takes."""


def _sheet_rows(book: zipfile.ZipFile, part: str, shared: list[str]) -> Iterator[tuple[int, list]]:
    """(row number, cells) of a sheet.

    Rows of plain cells, as programs write them, are cut from the text; from the
    first row of any other form on, the XML reader goes on.
    """
    done, dates, from_1904 = 0, _date_styles(book), _counts_from_1904(book)
    try:
        for found in _plain_rows(book, part, shared, dates, from_1904):
            done += 1
            yield found
        return
    except _OddSheetError:
        pass
    yield from itertools.islice(_element_rows(book, part, shared, dates, from_1904), done, None)


def _element_rows(
    book: zipfile.ZipFile, part: str, shared: list[str], dates: set[int], from_1904: bool
) -> Iterator[tuple[int, list]]:
    position = 0
    for _, node in ElementTree.iterparse(book.open(part)):
        if node.tag != f"{_MAIN}row":
            continue
        position = int(node.get("r", position + 1))
        cells: list[str | None] = []
        for cell in node.iter(f"{_MAIN}c"):
            at = _column_index(cell.get("r")) if cell.get("r") else len(cells)
            cells += [None] * (at + 1 - len(cells))
            cells[at] = _cell_text(cell, shared, dates, from_1904)
        node.clear()
        yield position - 1, cells


def _plain_rows(
    book: zipfile.ZipFile, part: str, shared: list[str], dates: set[int], from_1904: bool
) -> Iterator[tuple[int, list]]:
    """Rows cut from the text of a sheet; what stands before and after them goes through the XML reader."""
    frame = ElementTree.XMLPullParser(["start", "end"])
    position, rest, inside = 0, "", False
    for text in _texts(book, part):
        rest += text
        if not inside:
            head, mark, rest = rest.partition("<row")
            frame.feed(head)
            if not mark:
                continue
            rest, inside = mark + rest, True
            opened = [(event, node.tag) for event, node in frame.read_events()][-1:]
            if opened != [("start", f"{_MAIN}sheetData")]:
                raise _OddSheetError
        *rows, rest = rest.split("</row>")
        for row in rows:
            if "]]>" in row:
                raise _OddSheetError
            at = 0
            while True:
                begin = _ROW_BEGIN.match(row, at)
                if begin is None:
                    raise _OddSheetError
                number, empty, at = *begin.groups(), begin.end()
                position = int(number) if number else position + 1
                if empty:
                    yield position - 1, []
                    continue
                yield position - 1, _plain_cells(row[at:], shared, dates, from_1904)
                break
    while begin := _ROW_BEGIN.match(rest):
        if not begin[2]:
            raise _OddSheetError
        position = int(begin[1]) if begin[1] else position + 1
        yield position - 1, []
        rest = rest[begin.end() :]
    if "<row" in rest:
        raise _OddSheetError
    frame.feed(rest)
    frame.close()


def _texts(book: zipfile.ZipFile, part: str) -> Iterator[str]:
    """The text of a sheet in pieces, line ends as XML has them."""
    decode = codecs.getincrementaldecoder("utf-8")("strict").decode
    with book.open(part) as file:
        held = ""
        for piece in itertools.chain(iter(lambda: file.read(1 << 18), b""), [b""]):
            if len(piece.translate(None, _NO_TEXT)) < len(piece):
                raise _OddSheetError
            try:
                text = held + decode(piece, not piece)
            except UnicodeDecodeError as error:
                raise _OddSheetError from error
            if "\ufffe" in text or "\uffff" in text:
                raise _OddSheetError
            held = "\r" if text.endswith("\r") and piece else ""
            yield text.removesuffix(held).replace("\r\n", "\n").replace("\r", "\n")


def _plain_cells(body: str, shared: list[str], dates: set[int], from_1904: bool) -> list[str | None]:
    before, *found = body.split("<c")
    if before:
        raise _OddSheetError
    if ' r="' not in body:
        return [None if text == "/>" else _plain_cell(text, shared, dates, from_1904)[1] for text in found]
    cells: list[str | None] = []
    for text in found:
        letters, value = _plain_cell(text, shared, dates, from_1904)
        at = _place_of(letters) if letters else len(cells)
        cells += [None] * (at + 1 - len(cells))
        cells[at] = value
    return cells


def _plain_cell(text: str, shared: list[str], dates: set[int], from_1904: bool) -> tuple[str | None, str | None]:
    """Letters of the column, if given, and value."""
    if text.startswith(_INLINE) and text.endswith(_INLINE_END):  # by far the most common form of a text
        value = text[len(_INLINE) : -len(_INLINE_END)]
        if "<" not in value:
            return None, _unescaped(value)
    cell = _CELL.fullmatch(text)
    if cell is None:
        raise _OddSheetError
    letters, style, kind, later, inline, value = cell.groups()
    if kind == "inlineStr":
        return letters, _unescaped(inline or "")
    if value is None:
        return letters, None
    return letters, _value_text(kind or "n", style or later, _unescaped(value), shared, dates, from_1904)


def _unescaped(text: str) -> str:
    if "&" not in text:
        return text
    if "&" in _ENTITY.sub("", text):
        raise _OddSheetError
    return _ENTITY.sub(lambda m: _ENTITIES[m[1]] if m[1] else chr(int(m[2])), text)


def workbook_grid(files: DataFrame, sheet: str | int | None = None) -> DataFrame:
    """(path, sheet, row_no, cells) of workbooks held as (path, content) rows.

    One sheet by name or index, or all sheets.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from _grid_batches(path, content, sheet)

    return files.select("path", "content").mapInPandas(parse, GRID_SCHEMA)


def _grid_batches(path: str, content: bytes, sheet: str | int | None) -> Iterator[pd.DataFrame]:
    names = ["path", "sheet", "row_no", "cells"]
    book = zipfile.ZipFile(io.BytesIO(content))
    shared = _shared_texts(book)
    for index, (name, part) in enumerate(_sheets(book)):
        if sheet is not None and sheet not in (name, index):
            continue
        rows = []
        for row_no, cells in _sheet_rows(book, part, shared):
            rows.append((path, name, row_no, cells))
            if len(rows) == BATCH_ROWS:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)


def read_workbook_grid(spark: SparkSession, paths: list[str] | str, sheet: str | int | None = None) -> DataFrame:
    """Grid of all workbook files below the paths."""
    return workbook_grid(workbook_files(spark, paths), sheet)


@dataclass(frozen=True)
class SheetRule:
    """One table of a workbook: where it stands and which columns are wanted.

    ``resolve`` gets the trimmed header texts (without empty ones at the end)
    and gives, for each wanted column, the places whose first cell with a value
    counts; it raises ValueError for a header that is refused. ``period`` is a
    cell: sheet (None for the table's own), row and column. Rows are those from
    ``data_row`` (the row after the header) to ``last_row`` (exclusive).
    """

    sheet: str | int
    header_row: int
    columns: tuple[str, ...]
    resolve: Callable[[list[str]], list[list[int]]]
    period: tuple[str | int | None, int, int] | None = None
    data_row: int | None = None
    last_row: int | None = None


ROWS_SCHEMA = "rule string, path string, sheet string, row_no bigint, period string, values array<string>"


def sheet_rows(files: DataFrame, rules: dict[str, SheetRule]) -> DataFrame:
    """The rows of all rules from one parse of each workbook held as (path, content).

    ``values`` holds the rule's columns in order. A workbook that lacks a rule's
    sheet or header row, or whose header the rule refuses, fails the job with its
    path.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from _ruled_batches(path, content.as_py(), rules)

    return files.select("path", "content").mapInArrow(parse, ROWS_SCHEMA)


def _found(sheets: list[tuple[str, str]], wanted: str | int) -> tuple[str, str]:
    """Name and part of a sheet, by its place, its name or its name in another case."""
    if isinstance(wanted, int):
        if wanted < len(sheets):
            return sheets[wanted]
    else:
        for same in (lambda name: name == wanted, lambda name: name.casefold() == wanted.casefold()):
            for name, part in sheets:
                if same(name):
                    return name, part
    raise ValueError(f"it has no sheet {wanted}")


def _ruled_batches(path: str, content: bytes, rules: dict[str, SheetRule]) -> Iterator[pa.RecordBatch]:
    book = zipfile.ZipFile(io.BytesIO(content))
    shared, sheets = _shared_texts(book), _sheets(book)
    for label, rule in rules.items():
        try:
            name, part = _found(sheets, rule.sheet)
            period = None
            if rule.period is not None:
                at, row, col = rule.period
                period = _one_cell(book, part if at is None else _found(sheets, at)[1], shared, row, col)
            rows, places = [], None
            for row_no, cells in _sheet_rows(book, part, shared):
                if row_no == rule.header_row:
                    header = [(c or "").strip() for c in cells]
                    while header and not header[-1]:
                        header.pop()
                    places = rule.resolve(header)
                    single = [own[0] if own else -1 for own in places] if all(len(own) < 2 for own in places) else None
                    width = max((i for own in places for i in own), default=-1) + 1
                first = rule.header_row + 1 if rule.data_row is None else rule.data_row
                if row_no < first or (rule.last_row is not None and row_no >= rule.last_row):
                    continue
                if places is None:
                    raise ValueError(f"it has no header at row {rule.header_row}")
                cells += [None] * (width - len(cells))
                if single is None:
                    values = [next((cells[i] for i in own if cells[i] is not None), None) for own in places]
                else:
                    values = [cells[i] if i >= 0 else None for i in single]
                rows.append((label, path, name, row_no, period, values))
                if len(rows) == BATCH_ROWS:
                    yield _ruled(rows)
                    rows = []
        except ValueError as error:
            raise ValueError(f"report {path} is refused: {error}") from error
        if rows:
            yield _ruled(rows)


def _ruled(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.string())]
    columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.record_batch(columns, names=["rule", "path", "sheet", "row_no", "period", "values"])


def _one_cell(book: zipfile.ZipFile, part: str, shared: list[str], row: int, col: int) -> str | None:
    for row_no, cells in _sheet_rows(book, part, shared):
        if row_no >= row:
            return cells[col] if row_no == row and col < len(cells) else None
    return None


def rule_table(rows: DataFrame, label: str, rule: SheetRule) -> DataFrame:
    """The columns of one rule, with ``path`` and, if it has one, ``period``."""
    kept = ["path", "period"] if rule.period is not None else ["path"]
    return rows.where(F.col("rule") == label).select(*kept, *[F.get("values", F.lit(i)).alias(c) for i, c in enumerate(rule.columns)])


def workbook_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, content) of all workbook files below the paths."""
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter="*.xlsx", recursiveFileLookup="true")
        .load(paths)
    )
