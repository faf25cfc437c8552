"""The ZIP reader on ZIP64 directories and on archives of other writers."""

import gzip
import io
import json
import zipfile

import pytest

from tidemark.llm import warc_archive


def archive(path, data, index, **options):
    """``data``: member -> records; ``index``: member -> (data member, record numbers)."""
    spots = {}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED, **options) as out:
        for name, records in data.items():
            held = io.BytesIO()
            for k, record in enumerate(records):
                packed = gzip.compress(record) if name.endswith(".gz") else record
                spots[name, k] = (held.tell(), len(packed))
                held.write(packed)
            out.writestr(f"archive/{name}", held.getvalue())
        out.writestr("pages/pages.jsonl", "{}\n", zipfile.ZIP_DEFLATED)
        for name, (member, numbers) in index.items():
            lines = ["!meta {\"format\": \"cdxj\"}"] + [
                f"com,example)/{k} 20240101000000 " + json.dumps({"filename": member, "offset": str(spots[member, k][0]), "length": spots[member, k][1]})
                for k in numbers
            ]
            text = "\n".join(lines).encode()
            out.writestr(f"indexes/{name}", gzip.compress(text) if name.endswith(".gz") else text)
    return str(path)


def test_members_of_other_writers(tmp_path):
    one, two = [f"one {k}".encode() * 50 for k in range(5)], [f"two {k}".encode() * 9 for k in range(4)]
    path = archive(
        tmp_path / "a.wacz", {"x.warc.gz": one, "deep/y.warc": two},
        {"a.cdxj": ("x.warc.gz", [0, 1, 2]), "b.cdx.gz": ("x.warc.gz", [2, 4]), "c.cdx": ("deep/y.warc", [3, 1])},
    )
    assert sorted(warc_archive.read_ranges(path)) == sorted([one[0], one[1], one[2], one[4], two[1], two[3]])


def test_missing_members_are_named(tmp_path):
    path = archive(tmp_path / "a.wacz", {"x.warc.gz": [b"r"]}, {})
    with pytest.raises(ValueError, match="no stored index"):
        list(warc_archive.read_ranges(path))
    with zipfile.ZipFile(path, "a") as out:
        out.writestr("indexes/i.cdxj", 'k 1 {"filename": "gone.warc.gz", "offset": 0, "length": 1}')
    with pytest.raises(ValueError, match="gone.warc.gz"):
        list(warc_archive.read_ranges(path))


def test_zip64_directory(tmp_path, monkeypatch):
    """With the writer's limits lowered, sizes, offsets and the directory's end are in ZIP64 form."""
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    records = [f"record {k}".encode() * 20 for k in range(30)]
    path = archive(tmp_path / "z.wacz", {"x.warc.gz": records}, {"i.cdxj": ("x.warc.gz", range(30))}, allowZip64=True)
    raw = bytearray(open(path, "rb").read())
    assert b"PK\x06\x06" in raw and b"PK\x06\x07" in raw  # ZIP64 end of central directory and its locator
    end = raw.rfind(b"PK\x05\x06")
    raw[end + 8 : end + 20] = b"\xff" * 12  # as in an archive beyond the limits: numbers, size and offset
    with open(path, "wb") as file:
        file.write(raw)
    central = raw.find(b"PK\x01\x02")
    assert raw[central + 20 : central + 24] == b"\xff" * 4  # the size is in the extra field
    with open(path, "rb") as file:
        listed = {name: (packed, full) for name, _, _, packed, full in warc_archive.directory(file, len(raw))}
    with zipfile.ZipFile(path) as known:
        assert listed == {i.filename: (i.compress_size, i.file_size) for i in known.infolist()}
    assert list(warc_archive.read_ranges(path)) == records
