"""A line source of its own: follows growing text files of a folder.

Unlike the built-in file source it picks up lines appended to known files. Offsets are the files' sizes, which the
folder's listing tells, so the driver opens no file, and a batch consists of byte ranges of the files that grew.
A range gives the lines whose newline lies in it: an executor looks back to where the first of them begins, and
a last line without a newline waits until it has one. A file that got shorter was replaced and is read anew.

Register with ``spark.dataSource.register(LineSource)`` and read with
``spark.readStream.format("followed_lines").load(folder)``. ``rangeBytes`` bounds what one task reads.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import ExitStack
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20


def opened(fs: pafs.FileSystem, path: str) -> pa.NativeFile:
    return fs.open_input_file(path)


class ByteRange(InputPartition):
    """The lines of one file whose newline lies in ``[start, stop)``."""

    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class LineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "followed_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: StructType) -> LineStreamReader:
        return LineStreamReader(_folder(self.options["path"]), int(self.options.get("rangeBytes", RANGE_BYTES)))


class LineStreamReader(DataSourceStreamReader):
    def __init__(self, folder: str, range_bytes: int):
        self.folder, self.range_bytes = folder, range_bytes

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        infos = fs.get_file_info(pafs.FileSelector(root, recursive=False))
        return {"files": json.dumps({i.path: i.size for i in infos if i.is_file}, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        done, ends = json.loads(start["files"]), json.loads(end["files"])
        ranges = []
        for path, stop in ends.items():
            begin = done.get(path, 0)
            for low in range(begin if begin <= stop else 0, stop, self.range_bytes):
                ranges.append(ByteRange(path, low, min(low + self.range_bytes, stop)))
        return ranges

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.folder)
        with opened(fs, partition.path) as f:
            position, carried = partition.start, None
            while position < partition.stop:
                f.seek(position)
                block = f.read(min(BLOCK_BYTES, partition.stop - position))
                if not block:
                    break
                cut = block.rfind(b"\n")
                if cut >= 0:
                    if carried is None:
                        carried = _line_head(f, position)
                    yield _lines(b"".join([*carried, block[:cut]]))
                    carried = [block[cut + 1 :]]
                elif carried is not None:
                    carried.append(block)
                position += len(block)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def _folder(path: str) -> str:
    """Hadoop writes local paths as ``file:/x``, which is no URI to Arrow."""
    return path.removeprefix("file:") if path.startswith("file:/") and path[6:7] != "/" else path


def _line_head(f: pa.NativeFile, position: int) -> list[bytes]:
    """What stands before ``position`` of the line that it lies in, piece by piece."""
    pieces: list[bytes] = []
    while position > 0:
        low = max(0, position - BLOCK_BYTES)
        f.seek(low)
        block = f.read(position - low)
        cut = block.rfind(b"\n")
        pieces.append(block[cut + 1 :])
        if cut >= 0:
            break
        position = low
    return pieces[::-1]


def _lines(text: bytes) -> pa.RecordBatch:
    """Text without its last newline as one row per line, split by Arrow; bytes that are no UTF-8 are replaced."""
    whole = pa.array([text.decode("utf-8", errors="replace")], pa.large_string())
    values = pc.list_flatten(pc.split_pattern(whole, "\n")).cast(pa.string())
    return pa.RecordBatch.from_arrays([values], names=["value"])


def append_lines(rows: DataFrame, folder: str, files: int, value: str = "value") -> None:
    """Append lines to ``files`` files of a shared folder, each written by one task.

    A task first cuts its file back to the length it had, so a task that runs again does not write twice.
    """
    place = Path(_folder(folder))
    place.mkdir(parents=True, exist_ok=True)
    lengths = {p.name: p.stat().st_size for p in place.iterdir()}
    number = F.pmod(F.xxhash64(value), F.lit(files)).cast("int").alias("file")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ExitStack() as stack:
            out = {}
            for batch in batches:
                for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if file not in out:
                        name = f"lines-{file}.log"
                        out[file] = stack.enter_context(open(place / name, "ab"))
                        out[file].truncate(lengths.get(name, 0))
                    out[file].write(f"{line}\n".encode())
        yield pa.RecordBatch.from_arrays([pa.array([len(out)], pa.int32())], names=["files"])

    rows.select(number, value).repartition("file").mapInArrow(write, "files int").agg(F.sum("files")).collect()
