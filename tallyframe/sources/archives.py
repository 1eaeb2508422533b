"""Members of tar archives as rows: a data source with a partition for each range of members, which reads those bytes alone."""

from __future__ import annotations

import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of members in one partition, about. A larger member is one by itself.
RANGE_BYTES = 64 << 20


def _open(path: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


class _Range(InputPartition):
    def __init__(self, archive: str, members: list[tuple[str, int, int]] | None):
        self.archive, self.members = archive, members


class _MemberReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.suffix = options["path"], options.get("suffix", "")
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))

    def _archives(self) -> list[str]:
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(self.path)
        if system.get_file_info(name).type == fs.FileType.File:
            return [self.path]
        found = system.get_file_info(fs.FileSelector(name, recursive=True))
        base = self.path.rstrip("/")
        return sorted(base + f.path[len(name.rstrip("/")) :] for f in found if f.path.endswith((".tar", ".tar.gz", ".tgz")))

    def partitions(self) -> list[_Range]:
        """Only headers are read here, and of compressed archives nothing: they can't be entered in the middle and are one partition."""
        out = []
        for archive in self._archives():
            if not archive.endswith(".tar"):
                out.append(_Range(archive, None))
                continue
            held, size = [], 0
            with _open(archive) as raw, tarfile.open(fileobj=raw, mode="r:") as tar:
                for m in tar:
                    if not m.isfile() or not m.name.endswith(self.suffix):
                        continue
                    if held and size + m.size > self.range_bytes:
                        out.append(_Range(archive, held))
                        held, size = [], 0
                    held.append((m.name, m.offset_data, m.size))
                    size += m.size
            if held:
                out.append(_Range(archive, held))
        return out or [_Range("", [])]

    def read(self, partition: _Range) -> Iterator[tuple]:
        if partition.members is None:
            with _open(partition.archive) as raw, tarfile.open(fileobj=raw, mode="r|gz") as tar:
                for m in tar:
                    if m.isfile() and m.name.endswith(self.suffix):
                        yield partition.archive, m.name, m.size, tar.extractfile(m).read()
        elif partition.members:
            with _open(partition.archive) as raw:
                for name, start, size in partition.members:
                    data = raw.read_at(size, start)
                    if len(data) != size:
                        raise ValueError(f"{partition.archive} ends within {name}")
                    yield partition.archive, name, size, data


class TarMembers(DataSource):
    """spark.read.format("tar_members").load(path): a file, or all .tar, .tar.gz and .tgz below a folder. Options: suffix, rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        return "archive string, member string, size long, content binary"

    def reader(self, schema) -> DataSourceReader:  # noqa: ARG002
        return _MemberReader(self.options)


def write_archives(files: DataFrame, archive: str, name: str, content: str, folder: str) -> DataFrame:
    """(archive, path, members): a tar of each group of files(archive, name, content), written below folder, members in order of name.

    A group's rows stream through one task, sorted; rows of one archive are never held together.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        held, tar, raw, n, out = None, None, None, 0, []
        for f in frames:
            for a, m, data in zip(f["a"], f["m"], f["c"], strict=True):
                if a != held:
                    if tar is not None:
                        tar.close()
                        raw.close()
                        out.append((held, f"{folder}/{held}.tar", n))
                    system.create_dir(base, recursive=True)
                    raw = system.open_output_stream(f"{base}/{a}.tar")
                    held, tar, n = a, tarfile.open(fileobj=raw, mode="w|"), 0
                info = tarfile.TarInfo(m)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                n += 1
        if tar is not None:
            tar.close()
            raw.close()
            out.append((held, f"{folder}/{held}.tar", n))
        yield pd.DataFrame(out, columns=["archive", "path", "members"])

    rows = files.select(F.col(archive).cast("string").alias("a"), F.col(name).alias("m"), F.col(content).cast("binary").alias("c"))
    return rows.repartition("a").sortWithinPartitions("a", "m").mapInPandas(write, "archive string, path string, members long")


def first_rows(members: DataFrame) -> DataFrame:
    """(archive, member, row map<string, string>): the first row under the header of each member that is a table of tabs; members without one are left out."""
    lines = F.split(F.decode("content", "UTF-8"), "\r?\n")
    told = members.select("archive", "member", lines.alias("_l")).where((F.size("_l") > 1) & (F.get("_l", F.lit(1)) != ""))
    head, row = F.split(F.get("_l", F.lit(0)), "\t"), F.split(F.get("_l", F.lit(1)), "\t")
    n = F.least(F.size(head), F.size(row))
    return told.select("archive", "member", F.map_from_arrays(F.slice(head, F.lit(1), n), F.slice(row, F.lit(1), n)).alias("row"))
