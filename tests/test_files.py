"""Files opened, listed and unpacked inside tasks."""

import io
import os
import zipfile

import pytest
from conftest import rows
from test_sources import books, picture_book, put, sheet, summary_book

from platelake.plans.plot_table import plot_table
from platelake.sources import archives, files, walk, workbooks
from workload.fixtures import workbook_bytes


@pytest.mark.parametrize(
    "path, root, inner",
    [
        ("/data/a b%20[1].zip", "", "/data/a b%20[1].zip"),
        ("file:/data/x", "", "/data/x"),
        ("file:///data/x", "", "/data/x"),
        ("hdfs://namenode:8020/data/a b.zip", "hdfs://namenode:8020/", "/data/a b.zip"),
        ("s3a://bucket/a%20b/c:d.zip", "s3://bucket/", "/a%20b/c:d.zip"),
        ("hdfs://namenode:8020", "hdfs://namenode:8020/", ""),
    ],
)
def test_addresses(path, root, inner):
    assert files.address(path) == (root, inner)


def test_a_store_with_a_port(monkeypatch):
    """Host and port reach the file system as they are, and so does the name."""
    from pyarrow import fs

    asked = []

    class Systems:
        @staticmethod
        def from_uri(uri):
            asked.append(uri)
            return "system", "bucket/"

    monkeypatch.setattr(fs, "FileSystem", Systems)
    assert files.system_of("hdfs://namenode:8020/data/a b.zip") == ("system", "bucket/data/a b.zip")
    assert asked == ["hdfs://namenode:8020/"]
    with pytest.raises(ValueError):
        files.address("data/x")


class Counted(io.BytesIO):
    n_read = 0

    def read(self, size=-1):
        found = super().read(size)
        self.n_read += len(found)
        return found


def test_window():
    whole = files.Window(io.BytesIO(b"0123456789"))
    assert whole.length == 10 and whole.read() == b"0123456789"
    part = io.BufferedReader(files.Window(io.BytesIO(b"0123456789"), 2, 5))
    assert part.read(2) == b"23" and part.seek(-1, io.SEEK_END) == 4 and part.read() == b"6" and part.read() == b""


def test_only_the_wanted_parts_of_a_workbook_are_read():
    book = summary_book(("p_a", 1, 2), images={f"image{i}.emf": os.urandom(400_000) for i in range(1, 12)})
    counted = Counted(book)
    with zipfile.ZipFile(io.BufferedReader(files.Window(counted), files.BUFFER_BYTES)) as opened:
        parts = dict(workbooks._sheet_parts(opened))
        found = list(workbooks._Rows(opened, parts["Summary"], workbooks._shared_strings(opened)))
    assert found[-1][1][1] == ("p_a", "s")
    assert len(book) > 4_000_000 and counted.n_read < 8 * files.BUFFER_BYTES


def test_workbooks_by_path_and_by_place(spark, tmp_path):
    held = {f"d_L{i}_paste.xlsx": summary_book((f"p_c{i}", i, i + 0.5), images={"image1.emf": bytes([i]) * 4000}) for i in range(5)}
    for name, content in held.items():
        put(f"{tmp_path}/in/{name}", content)
    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA):
        with zipfile.ZipFile(f"{tmp_path}/{method}.zip", "w", method) as archive:
            for name, content in held.items():
                archive.writestr(f"a/{name}", content)
    expected = rows(workbooks.read_summaries(books(spark, *held.values()), keep=()))
    paths = spark.createDataFrame([(f"file:{tmp_path}/in/{n}",) for n in held], "path string")
    assert rows(workbooks.read_summaries(paths, keep=())) == expected
    for method in (0, 8, 12, 14):
        members, failed = archives.archive_workbooks(spark.createDataFrame([(f"{tmp_path}/{method}.zip",)], "path string"))
        placed = archives.placed_workbooks(members)
        assert failed.count() == 0
        assert rows(workbooks.read_summaries(placed, keep=())) == expected
        images = workbooks.read_images(placed, 100).select("cell_line", "n_bytes", "error")
        assert rows(images) == [(f"L{i}", 4000, None) for i in range(5)]
    gone = spark.createDataFrame([(f"{tmp_path}/in/none.xlsx",)], "path string")
    assert workbooks.read_summaries(gone, keep=("path",)).first()["error"].startswith("FileNotFoundError")


def test_walk_lists_all_names(spark, tmp_path):
    base = f"{tmp_path}/__b [2] 50%"
    kept = ["1 cells/_d_L1_paste.xlsx", "1 cells/.d_L2_paste.xlsx", "_b cells/d_L3.xlsx"]
    left = ["1 cells/~d_L4.xlsx", "1 cells/a.csv", "1 cells/deep cells/d_L5.xlsx", "d_L6_paste.xlsx", "other/d_L7_paste.xlsx"]
    for name in kept + left:
        put(f"{base}/{name}", b"xyz")
    found, failed = walk.batch_workbooks(spark, base)
    assert sorted(r["path"].split("50%/")[1] for r in found.collect()) == sorted(kept)
    assert rows(found.select("batch", "length").distinct()) == [("1 cells", 3), ("_b cells", 3)]
    assert found.filter("modified > current_timestamp() - interval 1 hour").count() == 3 and failed.count() == 0
    plots, _ = walk.plot_workbooks(spark, base + "/")
    assert [r[0] for r in rows(plots.select("cell_line"))] == ["L2", "L6", "L7", "d"]
    paths = [r["path"] for r in plots.collect()]
    assert all(p.startswith("file:/") for p in paths)


def test_walk_reports_folders_and_takes_empty_ones(spark, tmp_path):
    os.makedirs(f"{tmp_path}/a cells")
    found, failed = walk.batch_workbooks(spark, str(tmp_path))
    assert found.count() == failed.count() == 0
    found, failed = walk.batch_workbooks(spark, f"{tmp_path}/absent")
    assert found.count() == 0 and "FileNotFoundError" in failed.first()["error"]
    assert walk.spread(found).count() == 0


def members_of(spark, path):
    return archives.staged(archives.list_members(spark.createDataFrame([(str(path),)], "path string")))


def test_damaged_and_encrypted_members_are_errors(spark, tmp_path):
    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("good", b"good" * 1000)
        archive.writestr("flipped", os.urandom(5000))
        archive.writestr("stored", b"s" * 3000, zipfile.ZIP_STORED)
        archive.writestr("secret", b"locked")
        places = {i.filename: i for i in archive.infolist()}
    data = bytearray(path.read_bytes())
    data[places["flipped"].header_offset + 300] ^= 1
    data[places["stored"].header_offset + 100] ^= 1
    directory = data.index(b"PK\x01\x02")
    for _ in range(3):
        directory = data.index(b"PK\x01\x02", directory + 4)
    data[directory + 8] |= 1  # the encryption flag of the last entry
    path.write_bytes(data)
    found = {r["member"]: r for r in archives.open_members(members_of(spark, path)).collect()}
    assert bytes(found["good"]["content"]) == b"good" * 1000 and found["good"]["error"] is None
    assert "checksum" in found["stored"]["error"] and found["stored"]["content"] is None
    assert "encrypted" in found["secret"]["error"]
    assert found["flipped"]["content"] is None and found["flipped"]["error"] is not None


def test_members_in_chunks(spark, tmp_path, monkeypatch):
    held = {"a": os.urandom(2_500_000), "b": b"", "c": b"x" * 10, "d": b"y" * 3_000_000}
    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA):
        with zipfile.ZipFile(tmp_path / f"{method}.zip", "w", method) as archive:
            for name, content in held.items():
                archive.writestr(name, content)
        found = archives.member_chunks(members_of(spark, tmp_path / f"{method}.zip"), 1_000_000).orderBy("member", "chunk_no").collect()
        assert {r["error"] for r in found} == {None}
        assert [(r["member"], len(r["content"])) for r in found] == [("a", 10**6), ("a", 10**6), ("a", 500_000), ("c", 10), *[("d", 10**6)] * 3]
        assert b"".join(bytes(r["content"]) for r in found if r["member"] == "a") == held["a"]
        whole = archives.open_members(members_of(spark, tmp_path / f"{method}.zip"))
        assert {r["member"]: bytes(r["content"]) for r in whole.collect()} == held


def test_what_is_held_does_not_grow_with_the_member():
    """Pieces are bounded whatever the ratio of packing; a member longer than its entry says is refused."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("big", bytes(64 << 20))
        info = archive.infolist()[0]
    place = (info.header_offset, info.compress_size, info.compress_type, info.CRC, 0)
    pieces = archives.unpacked(out, *place, info.file_size)
    assert max(map(len, pieces)) <= archives.PIECE_BYTES
    with pytest.raises(zipfile.BadZipFile, match="more data"):
        list(archives.unpacked(out, *place, 1000))
    with pytest.raises(zipfile.BadZipFile, match="less data"):
        list(archives.unpacked(out, *place, info.file_size + 1))
    with pytest.raises(zipfile.BadZipFile, match="method 99"):
        list(archives.unpacked(out, info.header_offset, info.compress_size, 99, 0, 0, 1))
    with pytest.raises(zipfile.BadZipFile, match="ends inside"):
        list(archives.unpacked(io.BytesIO(out.getvalue()[:200]), *place, info.file_size))


def test_a_folder_that_is_named_like_an_archive(spark, tmp_path):
    put(f"{tmp_path}/in.zip/_d_L1_paste.xlsx", picture_book(4000, 4000))
    assert plot_table(spark, f"{tmp_path}/in.zip", f"{tmp_path}/out") == ["TA1", "TA2"]
    assert spark.read.parquet(f"{tmp_path}/out/images").filter("error is null").count() == 2


def test_first_sheet_by_path(spark, tmp_path):
    put(f"{tmp_path}/x.xlsx", workbook_bytes({"Zeta": sheet([["TAA", "IAA/Receptor"], ["g1", 3]]), "Alpha": sheet([["TAA", "IAA/Receptor"], ["no", 1]])}))
    found = workbooks.read_sheet(spark.createDataFrame([(f"{tmp_path}/x.xlsx",)], "path string"), workbooks.BAR_COLUMNS)
    assert rows(found.select("gene", "value", "error")) == [("g1", "3", None)]
