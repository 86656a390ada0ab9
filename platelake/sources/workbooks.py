"""Cells of spreadsheet files (values only) as rows.

Sheet choice, header lookup, column choice and the row limit happen while a file is read, so only wanted cells leave the
Python worker and no join or pivot is needed to put a table together again. Workbooks are rows that hold their bytes as ``content``, or
name a ``path`` or a place in an archive; of these only the directory and the parts asked for are read.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.etree import ElementTree

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from platelake.operators.sections import SECTION_COLUMN, SECTION_SHEETS
from platelake.sources.archives import explode_files, read_members

# The assay sheet, its header row and its columns; the compound list's columns; where images are kept.
SUMMARY_SHEET = "Summary"
SUMMARY_HEADER_ROW = 2
SUMMARY_COLUMNS = {
    "compound_raw": "Compound ID",
    "max_inhib_raw": "Max % Inhibition",
    "ic50_raw": "Corrected Abs IC50 nM",
}
COMPOUND_COLUMNS = {"ta_id": "TA_ID", "compound_name": "Compound"}
BAR_COLUMNS = {"gene": "TAA", "value": "IAA/Receptor"}
IMAGE_FOLDER, IMAGE_START, IMAGE_END = "xl/media/", "image", ".emf"

ERROR_CELL = "e"
PIECE_BYTES = 1 << 16

# Decimals of at most 15 digits in this form are already what Python prints for them.
SHORT_NUMBER = 16
PRINTED_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)\.(?!000)[0-9]*[1-9]")

CELL_FIELDS = [
    T.StructField("sheet", T.StringType()),
    T.StructField("row", T.IntegerType()),
    T.StructField("col", T.IntegerType()),
    T.StructField("value", T.StringType()),
    T.StructField("value_type", T.StringType()),
]


def _tag(element) -> str:
    return element.tag.rpartition("}")[2]


def _sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Sheet names with the archive member that holds each, in sheet order."""
    targets = {
        r.get("Id"): posixpath.normpath(posixpath.join("/xl", r.get("Target")))[1:]
        for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    parts = []
    for sheet in root.iter():
        if _tag(sheet) == "sheet":
            link = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
            parts.append((sheet.get("name"), targets[link]))
    return parts


def _text_of(element) -> str:
    """Text of a string item, phonetic hints left out."""
    texts = []
    for child in element:
        if _tag(child) == "t":
            texts.append(child.text or "")
        elif _tag(child) == "r":
            texts += [t.text or "" for t in child if _tag(t) == "t"]
    return "".join(texts)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    strings = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, element in ElementTree.iterparse(part):
            if _tag(element) == "si":
                strings.append(_text_of(element))
                element.clear()
    return strings


def _number_text(text: str) -> str:
    """Whole numbers without a point, all others as Python prints them."""
    if text.isdigit() or (len(text) <= SHORT_NUMBER and PRINTED_NUMBER.fullmatch(text)):
        return text
    number = float(text)
    return str(int(number)) if number.is_integer() else repr(number)


def _column_of(reference: str) -> int:
    column = 0
    for letter in reference.rstrip("0123456789"):
        column = column * 26 + ord(letter.upper()) - 64
    return column


def _cell_value(cell, strings: list[str]) -> tuple[str, str] | None:
    """``(text, type)`` with type s, n, b or e; None for an empty cell."""
    kind = cell.get("t", "n")
    value = None
    for child in cell:
        tag = child.tag
        if tag.endswith("}v"):
            value = child.text
        elif tag.endswith("}is"):
            return _text_of(child), "s"
    if value is None:
        return None
    if kind == "n":
        return _number_text(value), "n"
    if kind == "s":
        return strings[int(value)], "s"
    if kind == "b":
        return ("True" if value.strip() == "1" else "False"), "b"
    return value, (ERROR_CELL if kind == "e" else "s")


class _Rows:
    """``(row number, {column number: (text, type)})`` for each row that has a value, up to ``last_row``.

    The sheet is parsed in pieces and each row is dropped once taken, so memory does not grow with the sheet. After
    ``only`` is set, cells of other columns are passed over.
    """

    def __init__(self, book: zipfile.ZipFile, part: str, strings: list[str], last_row: int | None = None):
        self.book, self.part, self.strings, self.last_row = book, part, strings, last_row
        self.only: frozenset[int] | None = None

    def __iter__(self) -> Iterator[tuple[int, dict]]:
        number = 0
        with self.book.open(self.part) as sheet:
            for row in _row_elements(sheet):
                number = int(row.get("r", number + 1))
                if self.last_row is not None and number > self.last_row:
                    return
                column, values = 0, {}
                for cell in row:
                    reference = cell.get("r")
                    column = column + 1 if reference is None else _column_of(reference)
                    if self.only is not None and column not in self.only:
                        continue
                    if len(cell) == 1 and cell.get("t") is None and cell[0].tag.endswith("}v") and cell[0].text:
                        values[column] = _number_text(cell[0].text), "n"
                    elif (value := _cell_value(cell, self.strings)) is not None:
                        values[column] = value
                if values:
                    yield number, values


def _row_elements(sheet) -> Iterator[ElementTree.Element]:
    """Row elements of a sheet part, one piece of the file at a time."""
    builder = ElementTree.TreeBuilder()
    # An outer element opened by hand gives access to the tree while it grows.
    outer = builder.start("outer", {})
    parser = ElementTree.XMLParser(target=builder)
    rows = None
    while piece := sheet.read(PIECE_BYTES):
        parser.feed(piece)
        if rows is None and len(outer):
            rows = next((e for e in outer[0] if e.tag.endswith("}sheetData")), None)
        if rows is not None and len(rows) > 1:
            # The last row may still be growing.
            done = rows[:-1]
            del rows[:-1]
            yield from done
    parser.close()
    if rows is not None:
        yield from rows


def read_sheet(
    workbooks: DataFrame,
    columns: Mapping[str, str | int],
    sheet: str | None = None,
    header_row: int = 1,
    keep: Sequence[str] = ("path",),
) -> DataFrame:
    """Rows below the header of one sheet: ``keep…, row, <columns>, error``, all values as text.

    ``columns`` maps output names to header texts or column numbers; the first sheet is read when none is named. A workbook without the
    sheet or one of the columns gives a row with ``error`` set. Empty and error cells are NULL.
    """
    fields = [T.StructField("row", T.IntegerType())] + [T.StructField(c, T.StringType()) for c in columns]
    headers = list(columns.values())

    def each(file: io.IOBase) -> Iterator[tuple]:
        with zipfile.ZipFile(file) as book:
            parts = _sheet_parts(book)
            part = parts[0][1] if sheet is None else dict(reversed(parts)).get(sheet)
            if part is None:
                raise ValueError(f"no sheet {sheet!r}")
            rows = _Rows(book, part, _shared_strings(book))
            places = None
            for number, values in rows:
                if places is not None:
                    cells = [values.get(p) for p in places]
                    yield number, *[c[0] if c is not None and c[1] != ERROR_CELL else None for c in cells]
                elif number >= header_row:
                    found = {} if number > header_row else {t: c for c, (t, _) in sorted(values.items(), reverse=True)}
                    missing = [h for h in headers if isinstance(h, str) and h not in found]
                    if missing:
                        raise ValueError(f"no column {missing}")
                    places = [found[h] if isinstance(h, str) else h for h in headers]
                    rows.only = frozenset(places)
            if places is None:
                raise ValueError(f"no column {headers}")

    return explode_files(workbooks, keep, fields, each)


def read_cells(
    workbooks: DataFrame,
    sheets: Sequence[str] = SECTION_SHEETS,
    columns: Sequence[int] | None = (SECTION_COLUMN,),
    last_row: int | None = None,
    keep: Sequence[str] = ("path",),
) -> DataFrame:
    """Filled cells of the first of ``sheets`` that a workbook has: ``keep…, sheet, row, col, value, value_type, error``.

    A workbook with none of the sheets gives no rows.
    """
    wanted = None if columns is None else frozenset(columns)
    names = tuple(sheets)

    def each(file: io.IOBase) -> Iterator[tuple]:
        with zipfile.ZipFile(file) as book:
            parts = dict(reversed(_sheet_parts(book)))
            name = next((n for n in names if n in parts), None)
            if name is None:
                return
            rows = _Rows(book, parts[name], _shared_strings(book), last_row)
            rows.only = wanted
            for number, values in rows:
                for column, (text, kind) in values.items():
                    yield name, number, column, text, kind

    return explode_files(workbooks, keep, CELL_FIELDS, each)


def read_summaries(workbooks: DataFrame, keep: Sequence[str] = ("path", "batch", "file_name")) -> DataFrame:
    """The assay sheet of each workbook as raw readings."""
    return read_sheet(workbooks, SUMMARY_COLUMNS, SUMMARY_SHEET, SUMMARY_HEADER_ROW, keep)


def _image_place(member: str) -> tuple[int, str]:
    """What images are numbered by: the digits between the fixed parts of the name (0 without them), then the name."""
    inner = member.removeprefix(IMAGE_FOLDER).removeprefix(IMAGE_START).removesuffix(IMAGE_END)
    return (int(inner) if inner.isascii() and inner.isdigit() else 0), member


def read_images(
    workbooks: DataFrame, min_bytes: int, first: int | None = None, keep: Sequence[str] = ("path", "cell_line")
) -> DataFrame:
    """Embedded plot images above ``min_bytes``: ``keep…, member, n_bytes, content, plot_no, error``.

    ``plot_no`` counts the images of a workbook by their numbers, so nothing needs to be ranked later; with ``first`` only that
    many are unpacked. The workbook's directory tells which.
    """

    def numbered(infos: list[zipfile.ZipInfo]) -> list[tuple[int, zipfile.ZipInfo]]:
        places = sorted((_image_place(i.filename), n) for n, i in enumerate(infos))
        return [(plot_no, infos[n]) for plot_no, (_, n) in enumerate(places[:first], start=1)]

    pattern = f"^{re.escape(IMAGE_FOLDER)}[^/]+{re.escape(IMAGE_END)}$"
    return read_members(workbooks, pattern, keep, min_bytes, choose=numbered)
