"""A streaming source admitted by records, not by files.

A batch ends at ``max_records`` records, or when the oldest waiting record has waited
``window_s`` seconds, whichever comes first. An offset is a position in the sequence of all
records: files in order of modification time, then name, and each file's rows in order. A
batch is cut into ranges of files that executors read; only row counts reach the driver.

Spark asks a Python source for its latest offset without saying where the stream stands, so
the reader notes the end of each batch it plans (``progress``, a small file next to the
checkpoint). A batch is logged by Spark before it is planned, and a logged batch is planned
again after a failure, so the note is never behind a batch that counts.

Files must not change once they are there, and must appear in the order of their times, as
in any folder that is only appended to.
"""

from __future__ import annotations

import time
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from vaultlens.sources.ranges_io import file_system

MAX_RECORDS = 1000    # --- fixed values: the records and seconds a batch may wait for
WINDOW_S = 30.0
RANGE_RECORDS = 500   # records of one task's range, at least
TASKS = 16            # ranges of a micro-batch of several batches, about
POLL_S = 0.5          # between two listings


ADMITTED = "admitted"


@dataclass
class RecordRange(InputPartition):
    path: str
    first: int
    last: int
    place: int = 0   # of its first record in the micro-batch

    def __init__(self, path: str, first: int, last: int, place: int = 0):
        super().__init__(None)
        self.path, self.first, self.last, self.place = path, first, last, place


class RecordReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema = schema
        self.path = options["path"]
        self.progress = options["progress"]
        self.max_records = int(options.get("max_records", MAX_RECORDS))
        self.window_s = float(options.get("window_s", WINDOW_S))
        self.at_once = int(options.get("at_once", 1))
        self.files: list[str] = []
        self.ends: list[int] = []       # position after each file's last record
        self.listed = self.waiting_since = None

    def _list(self) -> int:
        """Adds the files that are new and gives the number of all records."""
        now = time.monotonic()
        if self.listed is None or now - self.listed >= POLL_S:
            self.listed = now
            system, root = file_system(self.path)
            found = system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
            known = set(self.files)
            new = sorted((f.mtime_ns, f.path) for f in found if f.is_file and f.path.endswith(".parquet")
                         and not any(p.startswith(("_", ".")) for p in f.path[len(root):].split("/")) and f.path not in known)
            for _, path in new:
                with system.open_input_file(path) as f:
                    rows = pq.ParquetFile(f).metadata.num_rows
                self.files.append(path)
                self.ends.append((self.ends[-1] if self.ends else 0) + rows)
        return self.ends[-1] if self.ends else 0

    def _planned(self, end: int | None = None) -> int:
        """The end of the last planned batch; with ``end``, notes it."""
        system, path = file_system(self.progress)
        if end is not None:
            system.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(f"{path}.new") as f:
                f.write(str(end).encode())
            system.move(f"{path}.new", path)
            return end
        if system.get_file_info(path).type == pafs.FileType.NotFound:
            return 0
        with system.open_input_file(path) as f:
            return int(f.read())

    def initialOffset(self) -> dict:
        return {"position": 0}

    def latestOffset(self) -> dict:
        at, there = self._planned(), self._list()
        if there - at >= self.max_records:
            self.waiting_since = None
            return {"position": at + min((there - at) // self.max_records, self.at_once) * self.max_records}
        if there > at:
            now = time.monotonic()
            self.waiting_since = self.waiting_since or now
            if now - self.waiting_since >= self.window_s:
                self.waiting_since = None
                return {"position": there}
        return {"position": at}

    def partitions(self, start: dict, end: dict) -> list[RecordRange]:
        lo, hi = start["position"], end["position"]
        self._list()
        size = max(RANGE_RECORDS, -(-(hi - lo) // TASKS) if self.at_once > 1 else 0)
        out, start, k = [], lo, bisect_right(self.ends, lo)
        while k < len(self.files) and lo < hi:
            begin = self.ends[k - 1] if k else 0
            stop = min(hi, self.ends[k])
            while lo < stop:
                cut = min(stop, lo + size)
                out.append(RecordRange(self.files[k], lo - begin, cut - begin, lo - start))
                lo = cut
            k += 1
        if lo < hi:
            raise OSError(f"{self.path}: records up to {hi} were planned, {lo} are there")
        self._planned(hi)
        return out

    def read(self, part: RecordRange):
        system, _ = file_system(self.path)
        schema = to_arrow_schema(self.schema, timestamp_utc=True)
        names = [n for n in self.schema.names if n != ADMITTED or self.at_once == 1]
        place = part.place
        with system.open_input_file(part.path) as f:
            file = pq.ParquetFile(f)
            sizes = [file.metadata.row_group(g).num_rows for g in range(file.num_row_groups)]
            begin = 0
            for g, end in enumerate(accumulate(sizes)):
                if begin < part.last and end > part.first:
                    rows = file.read_row_group(g, columns=names)
                    rows = rows.slice(max(0, part.first - begin), min(part.last, end) - max(part.first, begin))
                    # The columns in the source's order and types; text and times as Spark takes them.
                    columns = {n: rows.column(n).cast(schema.field(n).type) for n in names}
                    if self.at_once > 1:
                        columns[ADMITTED] = pa.array([p // self.max_records for p in range(place, place + rows.num_rows)], pa.int64())
                    place += rows.num_rows
                    rows = pa.table([columns[n] for n in self.schema.names], schema=schema)
                    yield from rows.to_batches()
                begin = end

    def commit(self, end: dict) -> None:
        pass


class RecordSource(DataSource):
    """Options: ``path`` (folder of Parquet files), ``progress`` (file for the note), ``max_records``,
    ``window_s``, ``at_once``."""

    @classmethod
    def name(cls) -> str:
        return "vaultlens_records"

    def schema(self):
        raise ValueError("the schema of the records must be given")

    def streamReader(self, schema: T.StructType) -> RecordReader:
        return RecordReader(schema, dict(self.options))


def record_stream(spark: SparkSession, path: str, schema: T.StructType, progress: str,
                  max_records: int = MAX_RECORDS, window_s: float = WINDOW_S, at_once: int = 1) -> DataFrame:
    """Records from the beginning of a folder, at most ``max_records`` a batch. ``progress`` belongs
    to one stream, like its checkpoint.

    A micro-batch costs about a second, however small. With ``at_once`` above 1 one of them takes
    up to so many batches where that many are waiting whole; the column ``admitted`` counts
    the batches of a micro-batch from 0 and keeps them apart."""
    spark.dataSource.register(RecordSource)
    if at_once > 1:
        schema = T.StructType([*schema.fields, T.StructField(ADMITTED, T.LongType())])
    return (spark.readStream.format(RecordSource.name()).schema(schema).option("path", path).option("progress", progress)
                 .option("max_records", max_records).option("window_s", window_s).option("at_once", at_once).load())
