"""A data source of FASTQ files whose partitions begin at records, so records need no second scan and no shuffle."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SPLIT_BYTES = 128 << 20
#: Records of a batch.
RECORDS = 4096
SCHEMA = "file string, at long, name string, seq string, qual string"


@dataclass(frozen=True)
class Stretch(InputPartition):
    """The records of a file that begin in [start, end); end None: to the end."""

    uri: str
    start: int
    end: int | None


def _opened(uri: str, start: int) -> io.BufferedReader:
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(uri)
    stream = files.open_input_stream(path, compression="gzip") if uri.endswith(".gz") else files.open_input_file(path)
    if start:
        stream.seek(start)
    return io.BufferedReader(stream, 1 << 20)


def _lines(stream: io.BufferedReader, at: int) -> Iterator[tuple[int, bytes]]:
    for line in stream:
        yield at, line.rstrip(b"\r\n")
        at += len(line)


def records(uri: str, start: int, end: int | None) -> Iterator[tuple[int, list[bytes]]]:
    """(place, four lines) of the records that begin in the stretch.

    Of the lines behind `start`, one begins a record if it starts with @, the next but one with +, and the two others are of one
    length. A line of qualities may start with @ too, but the next but one is bases then, which never start with +.
    """
    with _opened(uri, max(0, start - 1)) as stream:
        if start:
            skipped = stream.readline()  # the rest of a line that began before, or the end of one that ended there
            at = start - 1 + len(skipped)
        else:
            at = 0
        lines, held = _lines(stream, at), []
        found = not start
        for place, line in lines:
            if not held and found and (not line or end is not None and place >= end):
                if line:
                    return
                continue  # an empty line at the end
            held.append((place, line))
            if len(held) < 4:
                continue
            (first, name), (_, seq), (_, plus), (_, qual) = held
            if name.startswith(b"@") and plus.startswith(b"+") and len(seq) == len(qual):
                found = True
                if end is not None and first >= end:
                    return
                yield first, [name, seq, plus, qual]
                held = []
            elif found:
                raise ValueError(f"{uri}: no record at byte {first}")
            else:
                held.pop(0)
        if found and held:
            raise ValueError(f"{uri}: the record at byte {held[0][0]} is cut off")


class FastqReader(DataSourceReader):
    def __init__(self, uri: str, split: int) -> None:
        self.uri, self.split = uri, split

    def partitions(self) -> list[Stretch]:
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(self.uri)
        found = files.get_file_info(path)
        each = [found] if found.is_file else files.get_file_info(fs.FileSelector(path, recursive=True))
        scheme = self.uri.split("://")[0] + "://" if "://" in self.uri else ""
        out = []
        for info in sorted(each, key=lambda f: f.path):
            if not info.is_file or info.base_name.startswith(("_", ".")) or not info.size:
                continue
            uri = f"{scheme}{info.path}"
            cuts = [0] if uri.endswith(".gz") else range(0, info.size, self.split)
            out += [Stretch(uri, a, b) for a, b in zip(cuts, [*cuts[1:], None], strict=True)]
        return out or [Stretch("", 0, 0)]

    def read(self, partition: Stretch) -> Iterator[object]:
        import pyarrow as pa

        if not partition.uri:
            return
        held: list[tuple[int, list[bytes]]] = []

        def batch() -> object:
            text = lambda k: pa.array([r[k].decode("utf-8", "replace") for _, r in held])
            names = pa.array([r[0][1:].decode("utf-8", "replace") for _, r in held])
            return pa.RecordBatch.from_arrays([pa.array([partition.uri] * len(held)), pa.array([a for a, _ in held], pa.int64()), names, text(1), text(3)], ["file", "at", "name", "seq", "qual"])

        for record in records(partition.uri, partition.start, partition.end):
            held.append(record)
            if len(held) == RECORDS:
                yield batch()
                held = []
        if held:
            yield batch()


class Fastq(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> FastqReader:
        return FastqReader(re.sub("^file:/+", "/", self.options["path"]), int(self.options.get("split", SPLIT_BYTES)))


def read_fastq(spark: SparkSession, path: str, split: int = SPLIT_BYTES) -> DataFrame:
    """file, at (the record's first byte), name, seq, qual of a file or folder in a store that Arrow opens (local, HDFS, S3, GCS).

    Plain files are split about every `split` bytes; gz files are read each by one task. A record that is cut off, or isn't one, is
    an error. For other stores there is `files.read_fastq`.
    """
    spark.dataSource.register(Fastq)
    return spark.read.format("fastq").option("split", str(split)).load(path)
