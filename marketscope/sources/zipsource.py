"""S3: read the CSV members of the registry's zip archives.

A task per archive lists its members (zip central directories only). A task per member,
the largest first, then only inflates: it streams into text parts of about ``part_bytes``
in the shared checkpoint folder, cut at line ends outside quotes. The S1 dialect
reader parses the parts, so one member becomes many scan tasks.

A part's name depends on its archive, member and number only, and a temporary
file is renamed into place: a retried task rewrites the same parts.

    df = read_registry_zip(spark, folder, schema, ".EMPRECSV")

Missing values are read as '' (the registry convention); a schema field named
``arquivo`` receives the member name. No matching member: an empty table. Line ends
are judged by counting quotes, so every quote must be part of a quoted field (as in
the registry's files); a stray one in a member of several parts can give a larger
part, or a part that starts inside a quoted line break.
"""

from __future__ import annotations

import fnmatch
import zipfile
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketscope.session import shared_dir, ship_package
from marketscope.sources import files
from marketscope.sources.registry import registry_csv_options

MEMBER = "arquivo"
PART_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20


class ZipMember(NamedTuple):
    archive: str
    member: str
    size: int


MEMBERS = "archive string, member string, size long"


def _members_of(archive: str, pattern: str) -> list[ZipMember]:
    with files.open_input(archive) as fh, zipfile.ZipFile(fh) as z:
        return [ZipMember(archive, m.filename, m.file_size) for m in z.infolist() if fnmatch.fnmatch(m.filename, pattern)]


def list_members(spark: SparkSession, path: str, suffix: str) -> list[ZipMember]:
    """Archive members to read, the largest first: a task per archive reads its central directory only."""
    archives = [(a,) for a in files.list_files(path) if a.endswith(".zip")]
    if not archives:
        return []
    ship_package(spark)
    pattern = "*" + suffix

    def read(batches):
        import pandas as pd
        for pdf in batches:
            yield pd.DataFrame([m for a in pdf["archive"] for m in _members_of(a, pattern)], columns=list(ZipMember._fields))

    found = _one_task_each(spark, archives, "archive string").mapInPandas(read, MEMBERS)
    return sorted((ZipMember(*r) for r in found.collect()), key=lambda m: (-m.size, m.archive, m.member))


def _one_task_each(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A partition for each row (dealt one by one from a single partition)."""
    return spark.createDataFrame(rows, schema).coalesce(1).repartition(len(rows))


def _record_end(block: bytes, quoted: bool) -> int:
    """Offset after the last line end of ``block`` outside quotes, 0 if there is none.

    ``quoted`` tells whether the block ends inside a quoted field.
    """
    stop = len(block)
    while (at := block.rfind(b"\n", 0, stop)) >= 0:
        quoted ^= block.count(b'"', at, stop) % 2 == 1
        if not quoted:
            return at + 1
        stop = at
    return 0


def record_parts(stream, part_bytes: int, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
    """(part number, bytes) of a CSV byte stream; a part starts where a record starts."""
    part, size, quoted = 0, 0, False
    while block := stream.read(block_bytes):
        quoted ^= block.count(b'"') % 2 == 1
        end = _record_end(block, quoted) if size + len(block) >= part_bytes else 0
        if not end:
            yield part, block
            size += len(block)
            continue
        yield part, block[:end]
        part, size = part + 1, len(block) - end
        if size:
            yield part, block[end:]


def inflate_member(m: ZipMember, folder: str, part_bytes: int, attempt: str) -> int:
    """Write the parts of one member under ``folder``; returns how many."""
    target_dir = files.join(folder, f"{MEMBER}={quote(m.member, safe='')}")
    stem = quote(m.archive.rsplit("/", 1)[-1], safe="")
    files.make_dirs(target_dir)
    out, at = None, -1

    def close():
        if out is not None:
            out.close()
            files.move(files.join(target_dir, f"_{stem}-{at:05d}-{attempt}"), files.join(target_dir, f"{stem}-{at:05d}.csv"))

    with files.open_input(m.archive) as raw, zipfile.ZipFile(raw) as z, z.open(m.member) as fh:
        for part, data in record_parts(fh, part_bytes):
            if part != at:
                close()
                at, out = part, files.open_output(files.join(target_dir, f"_{stem}-{part:05d}-{attempt}"))
            out.write(data)
    close()
    return at + 1


def inflate(spark: SparkSession, path: str, suffix: str, part_bytes: int = PART_BYTES) -> str:
    """Inflate the matching members of every archive in ``path``; returns the folder of text parts."""
    ship_package(spark)
    folder = shared_dir(spark, "inflated")
    files.make_dirs(folder)
    members = list_members(spark, path, suffix)
    if members:
        def write(batches):
            import pandas as pd
            from pyspark import TaskContext
            attempt = str(TaskContext.get().taskAttemptId())
            for pdf in batches:
                yield pd.DataFrame({"partes": [inflate_member(ZipMember(*row), folder, part_bytes, attempt)
                                               for row in pdf.itertuples(index=False, name=None)]})

        _one_task_each(spark, members, MEMBERS).mapInPandas(write, "partes long").agg({"partes": "sum"}).collect()
    return folder


def read_registry_zip(spark: SparkSession, path: str, schema: T.StructType, suffix: str,
                      partitions: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Read the members ending in ``suffix`` (``*`` allowed) of every archive in ``path``."""
    folder = inflate(spark, path, suffix, part_bytes)
    data = [f for f in schema.fields if f.name != MEMBER]
    # the member's name comes back as the partition column of its folder
    df = (spark.read.schema(T.StructType([*data, T.StructField(MEMBER, T.StringType(), True)]))
          .options(**registry_csv_options(True))
          .csv(folder)
          .na.fill("")
          .select(*schema.names))
    return df.repartition(partitions) if partitions else df
