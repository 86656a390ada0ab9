"""Workbooks and archives made of table rows, so that the readers can be checked against the plain table.

Each Arrow batch becomes small files held in a ``content`` column: no grouping, and no file larger than its row limit
whatever the data. Rows are dealt out to all tasks first, as a table of one row group would make its files in a single one.
"""

from __future__ import annotations

import io
import sys
import uuid
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.session import gone_at_exit, shared_dir, staged
from platelake.sources import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_FILE = 1000
FILE_SCHEMA = "path string, content binary"

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def workbook_bytes(sheets: dict[str, str], extra: dict[str, bytes] | None = None) -> bytes:
    """A workbook from sheet name -> row XML, with further archive members."""
    names = list(sheets)
    listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
    targets = "".join(
        f'<Relationship Id="rId{i}" Type="{LINKS}/worksheet" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(names) + 1)
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        book.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{LINKS}"><sheets>{listed}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE}">{targets}</Relationships>')
        for i, name in enumerate(names, 1):
            body = f"<worksheet {MAIN}><sheetData>{sheets[name]}</sheetData></worksheet>"
            book.writestr(f"xl/worksheets/sheet{i}.xml", body)
        for member, content in (extra or {}).items():
            book.writestr(member, content)
    return out.getvalue()


def text_cell(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return F.concat(F.lit('<c t="inlineStr"><is><t xml:space="preserve">'), text, F.lit("</t></is></c>"))


def number_cell(number: Column) -> Column:
    return F.concat(F.lit("<c><v>"), number.cast("string"), F.lit("</v></c>"))


def dealt(df: DataFrame) -> DataFrame:
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def to_workbooks(df: DataFrame, cells: dict[str, Column], sheet: str, header_row: int, before: Sequence[str] = ("Notes",)) -> DataFrame:
    """Rows to ``path, content`` workbooks: a sheet with a header and one row per input row, cells in order, after empty sheets."""
    header = "".join(f'<c t="inlineStr"><is><t>{n}</t></is></c>' for n in cells)
    head = f'<row r="{header_row}">{header}</row>'
    blank = F.lit("<c/>")
    body = F.concat(*[F.coalesce(c, blank) for c in cells.values()], F.lit("</row>")).alias("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = batch.column(0).to_pylist()
            for start in range(0, len(rows), ROWS_PER_FILE):
                held = rows[start : start + ROWS_PER_FILE]
                xml = head + "".join(f'<row r="{header_row + i}">{r}' for i, r in enumerate(held, 1))
                number += 1
                path = f"{part:05d}/20260122_B{number}_paste.xlsx"
                yield pa.RecordBatch.from_pydict({"path": [path], "content": [workbook_bytes({**dict.fromkeys(before, ""), sheet: xml})]})

    return dealt(df.select(body)).mapInArrow(run, FILE_SCHEMA)


def to_archives(
    df: DataFrame, member: Column, content: Column, folders: Sequence[str], methods: Sequence[int] = (zipfile.ZIP_DEFLATED,), base: str | None = None
) -> DataFrame:
    """Rows to ``path, content`` zip files with one member per row, spread over the given inner folders and ways of packing.

    With ``base`` the task that makes a file writes it below that folder, and only its address, as ``path``, leaves the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_FILE):
                held = batch.slice(start, ROWS_PER_FILE).to_pydict()
                number += 1
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
                    for i, (name, data) in enumerate(zip(held["member"], held["content"])):
                        archive.writestr(f"{folders[i % len(folders)]}{name}", data, methods[i % len(methods)])
                path = f"{part:05d}/{number}.zip"
                if base is None:
                    yield pa.RecordBatch.from_pydict({"path": [path], "content": [out.getvalue()]})
                else:
                    files.write_file(f"{base}/{path}", out.getvalue())
                    yield pa.RecordBatch.from_pydict({"path": [f"{base}/{path}"]})

    return dealt(df.select(member.alias("member"), content.alias("content"))).mapInArrow(run, FILE_SCHEMA if base is None else "path string")


def shared_folder(spark: SparkSession, name: str) -> str:
    """The address of a new folder that goes when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    gone_at_exit(spark, path)
    return path


def to_files(contents: DataFrame, base: str | None = None) -> tuple[str, DataFrame]:
    """Rows of ``path, content`` as real files below ``base``, by default a new folder of the shared one: that folder, and the
    files' addresses."""
    if base is None:
        base = shared_folder(contents.sparkSession, "files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [f"{base}/{p}" for p in batch.column("path").to_pylist()]
            for path, content in zip(paths, batch.column("content")):
                files.write_file(path, content.as_py())
            yield pa.RecordBatch.from_pydict({"path": paths})

    return base, staged(contents.select("path", "content").mapInArrow(run, "path string"))
