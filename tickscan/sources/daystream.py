"""Raw day files as a stream: a Python data source whose offsets are (file, byte).

An offset names, for each file under the folder, the byte up to which its records have been handed
out; it always stands at a record's end, so a stream can stop and go on inside a file. Files are
taken in the order of their names, new ones as they appear, and a trigger admits about
``max_bytes``: planning reads the admitted bytes once to find where records end (quoted cells may hold
line ends), and cuts them into ranges of about ``range_bytes`` for the tasks. A record longer than the
bound is admitted whole. The driver keeps one number for each file.

After a restart the reader takes up the last offset that the stream's checkpoint has planned.

Files are opened by pyarrow's file systems (local paths, and the URIs pyarrow knows). A file whose
header lacks a needed column gives no rows, as in the batch reader, which lists it; one too short to
have a header is looked at again later. The last record of a file needs no line end unless
``growing`` is set.
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions.ticks import parse_trade_ts
from ..schemas import RAW_REQUIRED_COLUMNS
from ..session import prepare
from .dayfile import DAY_FILE
from .records import ends_inside

FORMAT = "tick_day_files"
RECORD_SCHEMA = "id string, sec_type string, last string, trading_date string, trading_time string, seq long, file string"
MAX_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
HEAD_BYTES = 64 << 10


def _open(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def read_range(uri: str, begin: int, end: int) -> bytes:
    store, path = _open(uri)
    with store.open_input_file(path) as f:
        return f.read_at(end - begin, begin)


def record_ends(data: bytes) -> Iterator[int]:
    """Where the records that begin at the start of ``data`` end, each just after its line feed."""
    at, inside = 0, False
    while True:
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end]
        if inside or b'"' in line:
            inside = ends_inside(line.decode("utf-8", "replace"), inside)
        at = end + 1
        if not inside:
            yield at


def last_record_end(data: bytes) -> int:
    """The last of ``record_ends``, or 0."""
    if b'"' not in data:
        return data.rfind(b"\n") + 1
    last = 0
    for last in record_ends(data):  # noqa: B007
        pass
    return last


class Range(InputPartition):
    def __init__(self, file: str, begin: int, end: int, places: list[int]):
        self.file, self.begin, self.end, self.places = file, begin, end, places


class DayFileStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.glob = options["path"], options.get("glob", "*.csv")
        self.max_bytes = int(options.get("max_bytes", MAX_BYTES))
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.growing = options.get("growing", "false") == "true"
        self.header_at, self.data_from = int(options.get("header_at", DAY_FILE[0])), int(options.get("data_from", DAY_FILE[1]))
        self.now: dict[str, int] = self._planned(options.get("checkpoint"))
        self.heads: dict[str, tuple[int, list[int] | None]] = {}

    @staticmethod
    def _planned(checkpoint: str | None) -> dict[str, int]:
        """The end of the last batch in the checkpoint's offset log."""
        if not checkpoint:
            return {}
        from pyarrow import fs
        store, path = _open(checkpoint)
        names = [i.base_name for i in store.get_file_info(fs.FileSelector(f"{path}/offsets", allow_not_found=True))]
        batches = [int(n) for n in names if n.isdigit()]
        if not batches:
            return {}
        with store.open_input_file(f"{path}/offsets/{max(batches)}") as f:
            return json.loads(f.read().decode().splitlines()[2])["files"]

    def _files(self) -> list[tuple[str, int]]:
        from pyarrow import fs
        store, path = _open(self.path)
        scheme = self.path.split("://")[0] + "://" if "://" in self.path else ""
        found = store.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        return sorted((scheme + i.path, i.size) for i in found if i.is_file and fnmatch(i.base_name, self.glob)
                      and not any(p.startswith(("_", ".")) for p in i.path[len(path):].split("/")))

    def _head(self, file: str, size: int) -> tuple[int, list[int] | None] | None:
        """(first data byte, places of the needed columns or None); None while the file is too short."""
        if file not in self.heads:
            take = HEAD_BYTES
            while True:
                data = read_range(file, 0, min(take, size))
                ends = []
                for end in record_ends(data):
                    ends.append(end)
                    if len(ends) == self.data_from:
                        break
                if len(ends) == self.data_from:
                    break
                if take >= size:
                    return None
                take *= 2
            header = data[ends[self.header_at - 1] if self.header_at else 0:ends[self.header_at]].decode("utf-8", "replace")
            names = [c.strip() for c in next(csv.reader(io.StringIO(header, newline="")), [])]
            held = all(c in names for c in RAW_REQUIRED_COLUMNS)
            self.heads[file] = (ends[-1], [names.index(c) for c in RAW_REQUIRED_COLUMNS] if held else None)
        return self.heads[file]

    def _end(self, file: str, begin: int, want: int, size: int, first: bool = True) -> int:
        """The last record's end in ``want`` bytes from ``begin``; if none is in them, that of the first
        record, or ``begin`` without ``first``."""
        while True:
            stop = min(size, begin + want)
            if stop == size and not self.growing:
                return size
            end = last_record_end(read_range(file, begin, stop))
            if end or stop == size or not first:
                return begin + end
            want *= 2

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        budget, now = self.max_bytes, dict(self.now)
        for file, size in self._files():
            if budget <= 0:
                break
            if now.get(file, -1) >= size:
                continue
            head = self._head(file, size)
            if head is None:
                continue
            begin = now.get(file, head[0])
            end = size if head[1] is None else self._end(file, begin, budget, size, budget == self.max_bytes)
            if end > begin or file not in now:
                now[file] = end
            if head[1] is not None:
                if end == begin and budget < self.max_bytes:
                    break
                budget -= end - begin
        self.now = now
        return {"files": dict(sorted(now.items()))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[InputPartition] = []
        for file, stop in end["files"].items():
            if start["files"].get(file) == stop:
                continue
            head = self._head(file, stop)
            if head is None or head[1] is None:
                continue
            at = start["files"].get(file, head[0])
            while at < stop:
                cut = stop if stop - at <= self.range_bytes else self._end(file, at, self.range_bytes, stop)
                out.append(Range(file, at, cut, head[1]))
                at = cut
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        data = read_range(partition.file, partition.begin, partition.end)
        cols: list[list] = [[] for _ in RAW_REQUIRED_COLUMNS]
        seq, at = [], 0
        ends = list(record_ends(data))
        if not ends or ends[-1] < len(data):
            ends.append(len(data))
        for end in ends:
            row = next(csv.reader(io.StringIO(data[at:end].decode("utf-8", "replace"), newline="")), [])
            if row:
                for col, place in zip(cols, partition.places):
                    col.append(row[place] or None if place < len(row) else None)
                seq.append(partition.begin + at)
            at = end
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in cols], pa.array(seq, pa.int64()),
                                          pa.array([partition.file] * len(seq), pa.string())],
                                         [c.split()[0] for c in RECORD_SCHEMA.split(", ")])


class DayFileStream(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORD_SCHEMA

    def streamReader(self, schema) -> DayFileStreamReader:
        return DayFileStreamReader(dict(self.options))


def stream_day_files(spark: SparkSession, path: str, checkpoint: str, path_glob: str = "*.csv", max_bytes: int = MAX_BYTES,
                     range_bytes: int = RANGE_BYTES, layout=DAY_FILE, growing: bool = False) -> DataFrame:
    """Ticks of the raw files under ``path`` as a stream. ``checkpoint`` is the folder given to the
    query that reads it; ``seq`` is the record's first byte in its file."""
    prepare(spark)
    spark.dataSource.register(DayFileStream)
    raw = (spark.readStream.format(FORMAT).option("path", path).option("glob", path_glob).option("checkpoint", checkpoint)
           .option("max_bytes", max_bytes).option("range_bytes", range_bytes).option("header_at", layout[0])
           .option("data_from", layout[1]).option("growing", str(growing).lower()).load())
    return raw.select(F.trim("id").alias("id"), "sec_type", F.trim("last").alias("last"),
                      parse_trade_ts("trading_date", "trading_time").alias("trade_timestamp"),
                      F.lit(None).cast("timestamp").alias("wallclock_timestamp"), F.lit(None).cast("long").alias("delay"), "seq", "file")
