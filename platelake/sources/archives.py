"""Members of zip archives as rows.

``read_members`` opens archives (a workbook is one) that rows hold as ``content`` or name by path or place. ``list_members`` takes paths: the
directory is read once, then its members are spread over tasks in chunks of bytes and read from their places, so one archive that
holds most of the data is still read by many tasks and may be larger than one row can hold. ``open_members`` gives them whole,
``member_chunks`` in chunks of a fixed size, both checked against the directory.
"""

from __future__ import annotations

import bz2
import io
import itertools
import lzma
import re
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from platelake.functions.identifiers import cell_line_of, file_name_of, is_workbook_name
from platelake.session import staged
from platelake.sources import files

FLUSH_ROWS = 10_000
FLUSH_BYTES = 16 << 20
CHUNK_BYTES = 64 << 20

SKIPPED_FOLDER = "__MACOSX"  # fixed value
MEMBER_FIELDS = [
    T.StructField("member", T.StringType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("content", T.BinaryType()),
]
ERROR_FIELD = T.StructField("error", T.StringType())


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows to record batches, closed early when binary values have filled them."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= FLUSH_ROWS or size >= FLUSH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


PLACE = ("at", "packed", "method", "crc", "flags")


class Opener:
    """Opens what a row holds or names: its ``content``, a place in an ``archive``, or a ``path``.

    A member that is stored as it is becomes a window of its archive, so only what is asked for is read; any other is
    unpacked, and checked, in memory. The archive stays open until a row names another.
    """

    def __init__(self, columns: Sequence[str]) -> None:
        kinds = {"content": ("content",), "at": ("archive", *PLACE, "n_bytes"), "path": ("path",)}
        self.columns = next(needed for mark, needed in kinds.items() if mark in columns)
        self.path = self.file = None

    def __call__(self, values: Sequence):
        if self.columns[0] == "content":
            return io.BytesIO(values[0])
        if self.columns[0] == "path":
            return files.open_file(values[0])
        path, *place = values
        self.go_to(path)
        at, packed, method, _, flags, _ = place
        if method == STORED and not flags & ENCRYPTED:
            return io.BufferedReader(Shared(self.file, *_inside(self.file, at, packed)), files.BUFFER_BYTES)
        return io.BytesIO(b"".join(unpacked(self.file, *place)))

    def go_to(self, path: str):
        """The archive at ``path``, opened unless it is open."""
        if path != self.path:
            self.close()
            self.file = files.open_file(path)
            self.path = path
        return self.file

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.path = self.file = None


class Shared(files.Window):
    """A window of a file that others use too."""

    def close(self) -> None:
        io.RawIOBase.close(self)


def explode_files(
    df: DataFrame, keep: Sequence[str], fields: list[T.StructField], each: Callable[[io.IOBase], Iterable[tuple]]
) -> DataFrame:
    """One row per item that ``each`` makes of a row's file (see ``Opener``), after the columns to keep, with an ``error`` column.

    What cannot be read gives one row with ``error`` set instead of failing the job.
    """
    schema = T.StructType([df.schema[k] for k in keep] + fields + [ERROR_FIELD])
    arrow = to_arrow_schema(schema)
    blank = (None,) * len(fields)
    n_keep = len(keep)
    opened_by = Opener(df.columns).columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = Opener(opened_by)

        def items(batch: pa.RecordBatch) -> Iterator[tuple]:
            for i in range(batch.num_rows):
                values = [c[i].as_py() for c in batch.columns]
                key = values[:n_keep]
                try:
                    with opener(values[n_keep:]) as file:
                        for item in each(file):
                            yield (*key, *item, None)
                except Exception as problem:
                    yield (*key, *blank, f"{type(problem).__name__}: {problem}")

        try:
            for batch in batches:
                yield from _batches(items(batch), arrow)
        finally:
            opener.close()

    columns = [F.col(c).alias(f"_{n}") for n, c in enumerate((*keep, *opened_by))]
    return df.select(*columns).mapInArrow(run, schema)


def read_members(
    df: DataFrame,
    pattern: str,
    keep: Sequence[str],
    min_bytes: int = -1,
    choose: Callable[[list[zipfile.ZipInfo]], list[tuple[int, zipfile.ZipInfo]]] | None = None,
) -> DataFrame:
    """Members of the archives that rows hold or name, whose name matches and whose size is above ``min_bytes``.

    The tests, and ``choose`` after them, use the archive's directory: members left out are never unpacked. ``choose``
    takes the infos that passed and gives pairs of a number and an info; the number becomes column ``plot_no``.
    """
    wanted = re.compile(pattern)

    def each(file: io.IOBase) -> Iterator[tuple]:
        with zipfile.ZipFile(file) as archive:
            infos = [
                i for i in archive.infolist()
                if not i.is_dir() and wanted.search(i.filename) and i.file_size > min_bytes
            ]
            if choose is None:
                yield from ((i.filename, i.file_size, archive.read(i)) for i in infos)
            else:
                yield from ((i.filename, i.file_size, archive.read(i), n) for n, i in choose(infos))

    numbered = [] if choose is None else [T.StructField("plot_no", T.IntegerType())]
    return explode_files(df, keep, MEMBER_FIELDS + numbered, each)


DIRECTORY_FIELDS = [
    T.StructField("archive", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("chunk", T.LongType()),
    T.StructField("at", T.LongType()),
    T.StructField("packed", T.LongType()),
    T.StructField("method", T.IntegerType()),
    T.StructField("crc", T.LongType()),
    T.StructField("flags", T.IntegerType()),
]
# Fixed values of the zip format: the size of a member's own header, the methods that are read, the flag of encryption.
MEMBER_HEADER = 30
STORED, DEFLATED, BZIP2, LZMA = 0, 8, 12, 14
ENCRYPTED = 1
#: What is held of a member at once, packed and unpacked.
PIECE_BYTES = 1 << 20


def list_members(found: DataFrame) -> DataFrame:
    """``path`` of archives to one row per member, from their directories alone, with the place of its bytes."""
    schema = T.StructType([*DIRECTORY_FIELDS, ERROR_FIELD])
    arrow = to_arrow_schema(schema)

    def entries(paths: Iterable[str]) -> Iterator[tuple]:
        for path in paths:
            try:
                with files.open_file(path) as file, zipfile.ZipFile(file) as archive:
                    before = 0
                    for info in archive.infolist():
                        if not info.is_dir():
                            place = (info.header_offset, info.compress_size, info.compress_type, info.CRC, info.flag_bits)
                            yield (path, info.filename, info.file_size, before // CHUNK_BYTES, *place, None)
                            before += info.compress_size
            except Exception as problem:
                yield (path, *[None] * 8, f"{type(problem).__name__}: {problem}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(entries(batch.column(0).to_pylist()), arrow)

    return found.select("path").mapInArrow(run, schema)


def _inside(file, at: int, packed: int) -> tuple[int, int]:
    """Where the packed bytes of the member with its header at ``at`` begin, and how many they are."""
    file.seek(at)
    head = file.read(MEMBER_HEADER)
    if head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no member where the directory says")
    name, extra = struct.unpack("<HH", head[26:30])
    return at + MEMBER_HEADER + name + extra, packed


def _raw(file, begin: int, left: int) -> Iterator[bytes]:
    file.seek(begin)
    while left:
        piece = file.read(min(PIECE_BYTES, left))
        if not piece:
            raise zipfile.BadZipFile("the archive ends inside the member")
        left -= len(piece)
        yield piece


def _inflated(pieces: Iterator[bytes]) -> Iterator[bytes]:
    decoder = zlib.decompressobj(-zlib.MAX_WBITS)
    for piece in pieces:
        while piece and not decoder.eof:
            yield decoder.decompress(piece, PIECE_BYTES)
            piece = decoder.unconsumed_tail
    yield decoder.flush()
    if not decoder.eof:
        raise zipfile.BadZipFile("the member's data has no end")


def _decoded(decoder, pieces: Iterable[bytes]) -> Iterator[bytes]:
    """What a ``bz2`` or ``lzma`` decoder makes of the pieces."""
    for piece in pieces:
        while not decoder.eof:
            yield decoder.decompress(piece, PIECE_BYTES)
            piece = b""
            if decoder.needs_input:
                break


def _lzma_pieces(pieces: Iterator[bytes]) -> Iterator[bytes]:
    # Before the data: version, length of the properties, and in them lc + 9 * (lp + 5 * pb) and the dictionary's size.
    first = next(pieces, b"")
    while len(first) < 9 and (more := next(pieces, b"")):
        first += more
    _, _, kind, size = struct.unpack("<HHBI", first[:9])
    wanted = {"id": lzma.FILTER_LZMA1, "lc": kind % 9, "lp": kind // 9 % 5, "pb": kind // 45, "dict_size": size}
    decoder = lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=[wanted])
    return _decoded(decoder, itertools.chain([first[9:]], pieces))


def unpacked(file, at: int, packed: int, method: int, crc: int, flags: int, n_bytes: int) -> Iterator[bytes]:
    """The bytes of one member in pieces, read from its place without the archive's directory.

    What is held does not grow with the member. Size and checksum are compared with the directory's at the end, so the last step
    fails on damaged data.
    """
    if flags & ENCRYPTED:
        raise zipfile.BadZipFile("encrypted")
    pieces = _raw(file, *_inside(file, at, packed))
    if method == DEFLATED:
        pieces = _inflated(pieces)
    elif method == BZIP2:
        pieces = _decoded(bz2.BZ2Decompressor(), pieces)
    elif method == LZMA:
        pieces = _lzma_pieces(pieces)
    elif method != STORED:
        raise zipfile.BadZipFile(f"compression method {method}")
    size = total = 0
    for piece in pieces:
        size += len(piece)
        if size > n_bytes:
            raise zipfile.BadZipFile("more data than the directory says")
        total = zlib.crc32(piece, total)
        yield piece
    if size < n_bytes:
        raise zipfile.BadZipFile("less data than the directory says")
    if total != crc:
        raise zipfile.BadZipFile("bad checksum")


def workbook_members(members: DataFrame) -> DataFrame:
    """Members that are workbooks, at any depth, with ``file_name`` and ``cell_line``."""
    name = file_name_of(F.col("member"))
    folder = F.regexp_replace(F.col("member"), "[^/]*$", "")
    return (
        members.filter(~folder.contains(SKIPPED_FOLDER))
        .withColumn("file_name", name)
        .filter(is_workbook_name(F.col("file_name")))
        .withColumn("cell_line", cell_line_of(F.col("file_name"), fallback=True))
    )


def spread_members(members: DataFrame) -> DataFrame:
    """Rows of ``list_members`` dealt out by archive and chunk, in the order of their places; only names and places travel.

    There are as many tasks as chunks, which is what takes time here: sized by the rows alone, the shuffle would put all
    these short names into a few tasks. ``members`` is gone through twice, so pass it staged.
    """
    tasks = max(1, members.select("archive", "chunk").distinct().count())
    # By ranges, as hashes would put some of these few keys into one task.
    return members.repartitionByRange(tasks, "archive", "chunk").sortWithinPartitions("archive", "at")


def member_chunks(members: DataFrame, size: int | None = None) -> DataFrame:
    """Rows of ``list_members`` to ``…, chunk_no, content, error``: a member's bytes in chunks of ``size``, the last may be shorter.

    With ``size`` NULL a member is one chunk. A member that is damaged or cannot be unpacked has a row with ``error`` and
    no chunk number after the chunks that could be read: without such a row all its chunks are right. A chunk is all that a task holds.
    """
    keep = [c for c in members.columns if c not in (*PLACE, "chunk", "error")]
    fields = [T.StructField("chunk_no", T.LongType()), T.StructField("content", T.BinaryType()), ERROR_FIELD]
    schema = T.StructType([members.schema[c] for c in keep] + fields)
    arrow = to_arrow_schema(schema)
    n_keep, at_archive, at_size = len(keep), keep.index("archive"), keep.index("n_bytes")

    def chunks(pieces: Iterator[bytes]) -> Iterator[bytes]:
        held = bytearray()
        for piece in pieces:
            held += piece
            while size is not None and len(held) >= size:
                yield bytes(held[:size])
                del held[:size]
        if held or size is None:
            yield bytes(held)

    def contents(rows: Iterable[tuple]) -> Iterator[tuple]:
        opener = Opener(("at",))
        try:
            for row in rows:
                kept, place = row[:n_keep], row[n_keep:]
                try:
                    file = opener.go_to(kept[at_archive])
                    for number, chunk in enumerate(chunks(unpacked(file, *place, kept[at_size]))):
                        yield (*kept, number, chunk, None)
                except Exception as problem:
                    yield (*kept, None, None, f"{type(problem).__name__}: {problem}")
        finally:
            opener.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        yield from _batches(contents(rows), arrow)

    return spread_members(members).select(*keep, *PLACE).mapInArrow(run, schema)


def open_members(members: DataFrame) -> DataFrame:
    """Add ``content`` (and ``error``) to rows of ``list_members``, whole and checked. ``members`` is gone through twice."""
    return member_chunks(members).drop("chunk_no")


def archive_workbooks(archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``path`` of zip files to their workbook members (for ``open_members``) and to ``path, error`` of unreadable ones."""
    found = staged(list_members(archives))
    failed = found.filter(F.col("error").isNotNull()).select(F.col("archive").alias("path"), "error")
    return workbook_members(found), failed


def member_path() -> Column:
    """The archive's path with the member's name after it."""
    return F.concat_ws("/", "archive", "member")


def read_archive_workbooks(members: DataFrame) -> DataFrame:
    """Workbook members to ``path, file_name, cell_line, n_bytes, content, error``."""
    return open_members(members).select(
        member_path().alias("path"), "file_name", "cell_line", "n_bytes", "content", "error"
    )


def placed_workbooks(members: DataFrame) -> DataFrame:
    """Workbook members as ``path, file_name, cell_line`` with their places, which the workbook readers open: no bytes travel."""
    place = ("archive", *PLACE, "n_bytes")
    return spread_members(members).select(member_path().alias("path"), "file_name", "cell_line", *place)
