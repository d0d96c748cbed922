"""Bulk ZIP archives of submissions as a Spark data source, with point lookups pushed into the archive's directory.

The directory is read once, when the scan is planned; partitions carry where their entries lie, so that a task seeks to
those bytes and reads no directory. The path may be a URI of any store that Arrow's file systems open (a local path too).
"""

from __future__ import annotations

import re
import struct
import zipfile
import zlib

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition


def opened(path: str):
    """A seekable stream of a path or URI."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else (fs.LocalFileSystem(), path)
    return system.open_input_file(name)


class Entries(InputPartition):
    def __init__(self, entries: list[tuple[int, int, int, int, int, int]]):
        self.entries = entries  # cik, place of the local header, compressed and whole size, method, checksum


class SubmissionsReader(DataSourceReader):
    """Partitions are runs of archive entries; filters on cik choose entries by name."""

    def __init__(self, options: dict):
        self.path, self.size, self.ciks = options["path"], int(options.get("entriesPerPartition", 2000)), None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("cik",):
                wanted = {int(v) for v in (f.value if isinstance(f, In) else [f.value])}
                self.ciks = wanted if self.ciks is None else self.ciks & wanted
            else:
                yield f

    def partitions(self):
        with opened(self.path) as stream, zipfile.ZipFile(stream) as z:
            found = [(int(i.filename[3:13]), i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC) for i in z.infolist() if re.fullmatch(r"CIK\d{10}\.json", i.filename)]
        if self.ciks is not None:
            found = [e for e in found if e[0] in self.ciks]
        found.sort(key=lambda e: e[1])  # a task reads forwards
        return [Entries(found[i : i + self.size]) for i in range(0, len(found), self.size)] or [Entries([])]

    def read(self, partition):
        if not partition.entries:
            return
        with opened(self.path) as stream:
            for cik, *entry in partition.entries:
                try:
                    yield cik, content(stream, *entry).decode("utf-8"), None
                except (OSError, ValueError, struct.error, zlib.error) as e:  # a bad entry is a row, the rest go on
                    yield cik, None, str(e)


def content(stream, place: int, packed: int, size: int, method: int, checksum: int) -> bytes:
    """An entry's bytes, from its local header on."""
    stream.seek(place)
    mark, name, extra = struct.unpack("<I22xHH", stream.read(30))
    if mark != 0x04034B50:
        raise ValueError(f"no entry at {place}")
    stream.seek(place + 30 + name + extra)
    data = stream.read(packed)
    if method == zipfile.ZIP_DEFLATED:
        data = zlib.decompressobj(-15).decompress(data, size)
    elif method != zipfile.ZIP_STORED:
        raise ValueError(f"compression {method} isn't known")
    if len(data) != size or zlib.crc32(data) != checksum:
        raise ValueError(f"the entry at {place} is damaged")
    return data


class SubmissionsZip(DataSource):
    """format("submissions_zip"): (cik, value, error) of each CIK##########.json; the path must be one that executors reach."""

    @classmethod
    def name(cls):
        return "submissions_zip"

    def schema(self):
        return "cik bigint, value string, error string"

    def reader(self, schema):
        return SubmissionsReader(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SubmissionsZip)
