"""Sound and video files by byte ranges: what their headers say, and samples read by many tasks.

Both are Python data sources. Files are opened through Arrow's file systems, so a range is read
where a file is, and nothing but headers and the asked range leaves it.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HEADERS = "path string, bytes long, kind string, duration double, rate long, channels int, bits int, width int, height int, data_at long, data_bytes long, fault string"
SAMPLES = "src string, rate long, pos long, x array<float>"
FIELDS = [f.split()[0] for f in HEADERS.split(", ")]
#: Files of one task that reads headers, samples of a block, and bytes of one task that reads samples.
FILES, BLOCK, SPLIT = 64, 1 << 16, 32 << 20
#: The widest description of a video that is read.
MOST_HEADER = 256 << 20


class Broken(ValueError):
    """What is wrong with a file."""


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def listed(path: str, ends: tuple[str, ...]) -> list[str]:
    """Files at or below the path, by name."""
    system, inner = opened(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    info = system.get_file_info(inner)
    found = [info] if info.is_file else system.get_file_info(pyarrow.fs.FileSelector(inner, recursive=True))
    return sorted(prefix + f.path for f in found if f.is_file and f.path.lower().endswith(ends))


def exactly(file: pa.NativeFile, at: int, n: int) -> bytes:
    file.seek(at)
    data = file.read(n)
    if len(data) < n:
        raise Broken("ends too early")
    return data


def riff(file: pa.NativeFile, size: int) -> dict:
    """Of a WAV file: format and where its samples are. The last chunk may be cut off, or say that it is endless."""
    if exactly(file, 8, 4) != b"WAVE":
        raise Broken("no WAVE")
    out, at = {"kind": "wav"}, 12
    while at + 8 <= size:
        name, length = struct.unpack("<4sI", exactly(file, at, 8))
        if name == b"fmt ":
            code, channels, rate, _, align, bits = struct.unpack("<HHIIHH", exactly(file, at + 8, 16))
            if not rate or not align:
                raise Broken("no rate")
            out |= {"rate": rate, "channels": channels, "bits": bits, "code": code, "align": align}
        elif name == b"data":
            if "rate" not in out:
                raise Broken("samples before their format")
            n = min(length, size - at - 8)
            n -= n % out["align"]
            return out | {"data_at": at + 8, "data_bytes": n, "duration": n / out["align"] / out["rate"]}
        at += 8 + length + length % 2
    raise Broken("no samples")


def boxes(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(name, first, end) of the boxes inside a box that is at hand."""
    while at + 8 <= end:
        size, name = struct.unpack(">I4s", data[at : at + 8])
        head = 8
        if size == 1:
            size, head = struct.unpack(">Q", data[at + 8 : at + 16])[0], 16
        size = size or end - at
        if size < head or at + size > end:
            raise Broken("a box of a wrong size")
        yield name, at + head, at + size
        at += size


def movie(data: bytes) -> dict:
    """Duration and geometry told by the description of a video."""

    def clock(at: int) -> tuple[int, int]:
        wide = data[at] == 1
        return struct.unpack(">IQ", data[at + 20 : at + 32]) if wide else struct.unpack(">II", data[at + 12 : at + 20])

    out: dict = {}
    for name, at, end in boxes(data, 0, len(data)):
        if name == b"mvhd":
            scale, length = clock(at)
            if not scale:
                raise Broken("no time scale")
            out["duration"] = length / scale
        elif name == b"trak":
            size, kind, rate = (0, 0), b"", 0
            for inner, a, b in boxes(data, at, end):
                if inner == b"tkhd":
                    size = tuple(v >> 16 for v in struct.unpack(">II", data[b - 8 : b]))
                elif inner == b"mdia":
                    for part, x, _ in boxes(data, a, b):
                        if part == b"hdlr":
                            kind = data[x + 8 : x + 12]
                        elif part == b"mdhd":
                            rate = clock(x)[0]
            if kind == b"vide" and all(size):
                out.setdefault("width", size[0]), out.setdefault("height", size[1])
            elif kind == b"soun":
                out.setdefault("rate", rate)
    if "duration" not in out:
        raise Broken("no duration")
    return out


def mp4(file: pa.NativeFile, size: int) -> dict:
    """Reads the heads of the outer boxes, and of all only the description."""
    at = 0
    while at + 8 <= size:
        length, name = struct.unpack(">I4s", exactly(file, at, 8))
        head = 8
        if length == 1:
            length, head = struct.unpack(">Q", exactly(file, at + 8, 8))[0], 16
        length = length or size - at
        if length < head:
            raise Broken("a box of a wrong size")
        if name == b"moov":
            if length > MOST_HEADER:
                raise Broken("a description of over 256 MB")
            return {"kind": "mp4"} | movie(exactly(file, at + head, length - head))
        at += length
    raise Broken("no description")


def header(path: str) -> dict:
    """What a file's header says; what is wrong with it in `fault`."""
    system, inner = opened(path)
    with system.open_input_file(inner) as file:
        size = file.size()
        out = {"path": path, "bytes": size}
        try:
            start = exactly(file, 0, 12)
            return out | (riff(file, size) if start[:4] == b"RIFF" else mp4(file, size))
        except (Broken, struct.error, IndexError) as wrong:
            return out | {"fault": str(wrong) or "not readable"}


@dataclass
class Files(InputPartition):
    paths: list[str]


class Headers(DataSource):
    """`media_headers`: a row for each file below `path` whose name ends with one of `ends`."""

    @classmethod
    def name(cls) -> str:
        return "media_headers"

    def schema(self) -> str:
        return HEADERS

    def reader(self, schema) -> DataSourceReader:
        return HeaderReader(self.options)


class HeaderReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.ends = options["path"], tuple(options.get("ends", ".wav,.mp4,.mov,.m4a").split(","))

    def partitions(self) -> list[Files]:
        found = listed(self.path, self.ends)
        return [Files(found[k : k + FILES]) for k in range(0, len(found), FILES)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        for path in partition.paths:
            found = header(path)
            yield tuple(found.get(f) for f in FIELDS)


@dataclass
class Range(InputPartition):
    path: str
    rate: int
    at: int
    first: int
    end: int


class Samples(DataSource):
    """`wav_samples`: blocks of samples of the 16-bit mono WAV files below `path`."""

    @classmethod
    def name(cls) -> str:
        return "wav_samples"

    def schema(self) -> str:
        return SAMPLES

    def reader(self, schema) -> DataSourceReader:
        return SampleReader(self.options)


class SampleReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.block, self.window, self.split = (int(options.get(k, v)) for k, v in (("block", BLOCK), ("window", 1), ("split", SPLIT)))

    def partitions(self) -> list[Range]:
        """Ranges of whole blocks and whole windows, so that no window is cut."""
        out, unit = [], math.lcm(self.block, self.window)
        step = max(1, self.split // 2 // unit) * unit
        for path in listed(self.path, (".wav",)):
            found = header(path)
            if found.get("fault") or (found["channels"], found["bits"], found["code"] in (1, 0xFFFE)) != (1, 16, True):
                raise ValueError(f"not 16-bit mono: {path} ({found.get('fault') or 'another format'})")
            total = found["data_bytes"] // 2
            out += [Range(path, found["rate"], found["data_at"], k, min(total, k + step)) for k in range(0, total, step)]
        return out or [Range("", 0, 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, inner = opened(partition.path)
        name = inner.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        with system.open_input_file(inner) as file:
            for pos in range(partition.first, partition.end, self.block):
                n = min(self.block, partition.end - pos)
                x = np.frombuffer(exactly(file, partition.at + 2 * pos, 2 * n), "<i2") / np.float32(32768)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([partition.rate], pa.int64()), pa.array([pos], pa.int64()), pa.array([x], pa.list_(pa.float32()))], names=["src", "rate", "pos", "x"])


def headers(spark: SparkSession, path: str, ends: str = ".wav,.mp4,.mov,.m4a") -> DataFrame:
    """path, bytes, kind, duration (s), rate, channels, bits, width, height, data_at, data_bytes, fault of the files."""
    spark.dataSource.register(Headers)
    return spark.read.format("media_headers").options(path=path, ends=ends).load()


def wav_blocks(spark: SparkSession, path: str, block: int = BLOCK, window: int = 1, split: int = SPLIT) -> DataFrame:
    """src, rate, pos, x: 16-bit mono WAV files in blocks of samples (array of -1 to 1) that begin at sample pos.

    A file is read by as many tasks as it has ranges of `split` bytes, each of whole blocks and whole
    windows; an empty file gives no rows, other formats are an error.
    """
    spark.dataSource.register(Samples)
    return spark.read.format("wav_samples").options(path=path, block=block, window=window, split=split).load()
