"""Files by their address, opened, written and listed inside tasks.

Addresses are those Spark lists: plain, ``file:/…`` or ``scheme://host:port/…``. Names are taken as they are; nothing in them is encoded.
"""

from __future__ import annotations

import datetime
import io
import os
from collections.abc import Iterator

#: What is read at once where a reader asks for little.
BUFFER_BYTES = 64 << 10
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def address(path: str) -> tuple[str, str]:
    """The address of the file system (empty for the local one) and the path inside it."""
    if path.startswith("/"):
        return "", path
    if path.startswith("file:"):
        return "", "/" + path.removeprefix("file:").lstrip("/")
    scheme, mark, rest = path.partition("://")
    if not mark:
        raise ValueError(f"no address: {path!r}")
    host, slash, below = rest.partition("/")
    return f"{SCHEMES.get(scheme, scheme)}://{host}/", slash + below


def system_of(path: str):
    """The file system that holds ``path``, and its name there."""
    from pyarrow import fs

    root, inner = address(path)
    if not root:
        return fs.LocalFileSystem(), inner
    system, base = fs.FileSystem.from_uri(root)
    return system, base.rstrip("/") + inner


class Window(io.RawIOBase):
    """Part of a seekable file as a file of its own; the whole file by default. Closing it closes the file."""

    def __init__(self, file, start: int = 0, length: int | None = None) -> None:
        self.file, self.start, self.at = file, start, 0
        if length is None:
            length = file.seek(0, io.SEEK_END)
            length = (file.tell() if length is None else length) - start
        self.length = length

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.at = max(0, offset + (0, self.at, self.length)[whence])
        return self.at

    def readinto(self, buffer) -> int:
        n = min(len(buffer), self.length - self.at)
        if n <= 0:
            return 0
        self.file.seek(self.start + self.at)
        data = self.file.read(n)
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)

    def close(self) -> None:
        if not self.closed:
            self.file.close()
        super().close()


def open_file(path: str) -> io.BufferedReader:
    """A seekable file; what is not asked for is not read, but for the rest of a buffer."""
    system, inner = system_of(path)
    return io.BufferedReader(Window(system.open_input_file(inner)), BUFFER_BYTES)


def write_file(path: str, content: bytes) -> None:
    """A file with this content, its folders made where they are missing."""
    system, inner = system_of(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    with system.open_output_stream(inner) as out:
        out.write(content)


def _utc(seconds: float) -> datetime.datetime:
    return datetime.datetime.fromtimestamp(seconds, datetime.UTC)


def list_folder(path: str) -> Iterator[tuple[str, int | None, datetime.datetime | None, bool]]:
    """Name, bytes, time and whether it is a folder, of everything directly in ``path``."""
    system, inner = system_of(path)
    if not address(path)[0]:  # one entry at a time, however many there are
        with os.scandir(inner) as entries:
            for entry in entries:
                about = entry.stat()
                yield entry.name, about.st_size, _utc(about.st_mtime), entry.is_dir()
        return
    from pyarrow import fs

    for info in system.get_file_info(fs.FileSelector(inner)):
        yield info.base_name, info.size, info.mtime, info.type == fs.FileType.Directory
