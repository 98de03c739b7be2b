"""Large single files read in parts: feature collections by byte ranges, rasters by windows.

Both are Python data sources, so Spark plans one partition per range or window and a lost one is read again alone. Files are opened through
``pyarrow.fs`` in the task, by any URI it knows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES = 32 << 20
#: Bytes read at once beyond the end of a range, and rows per batch.
MORE_BYTES, BATCH = 1 << 20, 2000

_BEGIN = re.compile(rb'\{\s*"type"\s*:\s*"Feature"\s*[,}]')
_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*+"|[{}]', re.DOTALL)
_AFTER = re.compile(rb"\s*(?:\]|,\s*\{|$)")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; ``file:/x`` and plain paths are local."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path) if re.match(r"\w+:", path) else f"file://{path}")


def files_of(path: str) -> list[tuple[str, int]]:
    """Data files under a path (or the file itself) and their sizes."""
    system, inner = opened(path)
    info = system.get_file_info(inner)
    scheme = path[:path.index(":") + 1] + "//" if re.match(r"\w+:", path) else "file://"
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
    kept = [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
    return sorted((f"{scheme}{f.path}", f.size) for f in kept)


class _Part(InputPartition):
    def __init__(self, **values: Any) -> None:
        self.__dict__.update(values)


def features_between(read: Callable[[int, int], bytes], start: int, end: int) -> Iterator[bytes]:
    """Texts of the features that begin in ``start`` to ``end``; ``read(at, n)`` gives bytes of the file.

    A range begins anywhere, inside a string or a nested object too. A feature begins at ``{"type":"Feature"``, which no string can hold (its quotes
    would be escaped), and ends where its braces close outside strings. A feature nested in the properties of another is
    told by what follows it: a list of features goes on with ``,{`` or ``]``.
    """
    data, base, at = read(start, end - start + MORE_BYTES), start, 0

    def grow() -> bool:
        nonlocal data
        more = read(base + len(data), MORE_BYTES)
        data += more
        return bool(more)

    def close(begin: int) -> int:
        """End of the object that begins there."""
        depth, place = 0, begin
        while True:
            token = _TOKEN.search(data, place)
            # A quote without its partner may only be cut off.
            quote = data.find(b'"', place, token.start() if token else len(data))
            if token is None or quote >= 0:
                if not grow():
                    return -1
                continue
            place = token.end()
            if token.group() == b"{":
                depth += 1
            elif token.group() == b"}":
                depth -= 1
                if not depth:
                    return place

    while True:
        found = _BEGIN.search(data, at)
        if found is None:
            if base + len(data) >= end + 256 or not grow():
                return
            continue
        if base + found.start() >= end:
            return
        finish = close(found.start())
        if finish < 0:
            return
        while len(data) - finish < 256 and grow():
            pass
        if _AFTER.match(data, finish):
            yield data[found.start():finish]
        at = finish
        if at > 8 * MORE_BYTES:  # what is behind is done with
            data, base, at = data[at:], base + at, 0


class FeatureRanges(DataSource):
    """Features of GeoJSON collections as text, one partition per ``rangeBytes`` of a file."""

    @classmethod
    def name(cls) -> str:
        return "feature_ranges"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        return _FeatureReader(self.options["path"], int(self.options.get("rangebytes", RANGE_BYTES)))


class _FeatureReader(DataSourceReader):
    def __init__(self, path: str, size: int) -> None:
        self.path, self.size = path, size

    def partitions(self) -> list[InputPartition]:
        return [_Part(file=f, start=at, end=min(at + self.size, n)) for f, n in files_of(self.path) for at in range(0, n, self.size)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, inner = opened(partition.file)
        with system.open_input_file(inner) as file:
            def read(at: int, n: int) -> bytes:
                file.seek(min(at, file.size()))
                return file.read(n)
            held: list[str] = []
            for text in features_between(read, partition.start, partition.end):
                held.append(text.decode("utf-8", "replace"))
                if len(held) == BATCH:
                    yield pa.record_batch([pa.array(held, pa.string())], ["value"])
                    held = []
            if held:
                yield pa.record_batch([pa.array(held, pa.string())], ["value"])


FEATURE = "properties MAP<STRING,STRING>, geometry STRUCT<type STRING, coordinates STRING>"


def read_feature_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``properties, geometry`` of large feature collections, each file read in as many tasks as it has ranges.

    Features begin with their type, as writers of such files put it; for others, and for features listed inside the properties of
    others, read whole documents."""
    spark.dataSource.register(FeatureRanges)
    text = spark.read.format("feature_ranges").option("rangeBytes", str(range_bytes)).load(path)
    return text.select(F.from_json("value", FEATURE).alias("f")).select("f.properties", "f.geometry").filter("geometry IS NOT NULL")


def read_windows(spark: SparkSession, rasters: Sequence[tuple[str, int, int]], decode: Callable[[str, int, int, int, int], dict[str, np.ndarray]],
                 bands: dict[str, str], size: int = 512, halo: int = 0) -> DataFrame:
    """``path, row_off, col_off, height, width`` and band arrays, one partition per window of ``size`` (and ``halo`` pixels around it).

    ``rasters``: path, height and width of each. ``decode(path, row, col, height, width)`` reads that part of a raster, so a large one is never
    one task; ``bands`` names what it returns and the element type (``int`` or ``double``). Offsets and sizes include the halo; windows at the far edges are smaller.
    """
    kinds = {"int": pa.int32(), "double": pa.float64()}
    schema = "path string, row_off int, col_off int, height int, width int, " + ", ".join(f"{b} array<{k}>" for b, k in bands.items())

    class Reader(DataSourceReader):
        def __init__(self, listed: str) -> None:
            self.listed = json.loads(listed)

        def partitions(self) -> list[InputPartition]:
            out = []
            for path, high, wide in self.listed:
                for r in range(0, high, size):
                    for c in range(0, wide, size):
                        top, left = max(0, r - halo), max(0, c - halo)
                        out.append(_Part(path=path, row=top, col=left, height=min(high, r + size + halo) - top, width=min(wide, c + size + halo) - left))
            return out

        def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
            p = partition
            found = decode(p.path, p.row, p.col, p.height, p.width)
            columns = [pa.array([p.path]), *[pa.array([v], pa.int32()) for v in (p.row, p.col, p.height, p.width)],
                       *[pa.array([np.asarray(found[b]).ravel()], pa.list_(kinds[k])) for b, k in bands.items()]]
            yield pa.record_batch(columns, ["path", "row_off", "col_off", "height", "width", *bands])

    class Windows(DataSource):
        @classmethod
        def name(cls) -> str:
            return "raster_windows"

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options["rasters"])

    spark.dataSource.register(Windows)
    return spark.read.format("raster_windows").option("rasters", json.dumps([list(r) for r in rasters])).load()
