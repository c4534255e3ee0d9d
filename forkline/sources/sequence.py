"""A stream of notifications in the order of their numbers, a bounded count per micro-batch.

A plain file stream takes files by modification time and admits whole files.  Here an offset is a
notification number: a micro-batch holds the next ``max_rows`` notifications after it, wherever their
files lie and whenever they were written.  The driver reads the numbers only; the notifications
themselves are read by the executors that need them.
"""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from forkline import schemas

START = -(1 << 62)
#: Notifications, blocks with all they hold, that one task of a micro-batch takes.
TASK = 500


class LateNotifications(RuntimeError):
    """Notifications turned up below an offset that the stream had passed."""


def _open(path: str):
    """The file system of a path and the path on it."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


class SequenceReader(SimpleDataSourceStreamReader):
    """Offsets are ``{"seq": last number taken, "rows": how many so far}``.  The count tells
    whether a file with earlier numbers came after them: then the stream stops with an error
    instead of leaving them out."""

    def __init__(self, path: str, max_rows: int):
        self.path, self.max_rows, self.numbers = path.rstrip("/"), max_rows, {}

    def _index(self) -> dict:
        """Sorted notification numbers by file; a file is read once, one column of it."""
        fs, root = _open(self.path)
        for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if info.is_file and info.base_name.endswith(".parquet") and info.base_name[0] not in "._":
                if info.base_name not in self.numbers:
                    seq = pq.read_table(info.path, columns=["seq"], filesystem=fs).column("seq")
                    self.numbers[info.base_name] = np.sort(seq.drop_null().to_numpy())
        return self.numbers

    def initialOffset(self) -> dict:
        return {"seq": START, "rows": 0}

    def read(self, start: dict):
        index = self._index().values()
        at = [int(np.searchsorted(n, start["seq"], side="right")) for n in index]
        if sum(at) != start["rows"]:
            raise LateNotifications(f"{sum(at) - start['rows']} notifications up to {start['seq']} came after it was passed")
        rest = np.concatenate([n[k:k + self.max_rows] for n, k in zip(index, at)] or [np.zeros(0, np.int64)])
        if not len(rest):
            return iter([]), start
        last = min(self.max_rows, len(rest)) - 1
        upto = int(np.partition(rest, last)[last])
        rows = sum(int(np.searchsorted(n, upto, side="right")) for n in index)
        end = {"seq": upto, "rows": rows}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict):
        lo, hi = start["seq"], end["seq"]
        found = [(f"{self.path}/{name}", lo, hi, int(np.searchsorted(n, hi, side="right") - np.searchsorted(n, lo, side="right")))
                 for name, n in sorted(self._index().items())]
        return iter([r for r in found if r[3]])


class SequenceSource(DataSource):
    """Rows name a file and the range of numbers, above ``lo`` and up to ``hi``, to take from it,
    with how many these are."""

    @classmethod
    def name(cls):
        return "notification_sequence"

    def schema(self):
        return "path string, lo bigint, hi bigint, rows bigint"

    def simpleStreamReader(self, schema):
        return SequenceReader(self.options["path"], int(self.options["maxRows"]))


def _leaves(file, names: list, fields: list | None) -> list:
    """Columns of a file to read: ``names``, of lists of blocks only the parts named in ``fields``."""
    if fields is None:
        return names
    found = []
    for i in range(file.metadata.num_columns):
        # a list's own two levels lie between its column and what a block holds
        path = file.metadata.schema.column(i).path.split(".")
        inside = ".".join(path[3:])
        if path[0] in names and (not inside or any(f"{inside}.".startswith(f"{f}.") for f in fields)):
            found.append(".".join(path))
    return found


def _fetch(names: list, fields: list | None = None):
    def run(batches):
        for ranges in batches:
            for r in ranges.to_pylist():
                fs, path = _open(r["path"])
                file = pq.ParquetFile(path, filesystem=fs)
                seq = [file.metadata.row_group(0).column(i).path_in_schema for i in range(file.metadata.num_columns)].index("seq") \
                    if file.metadata.num_row_groups else 0
                for g in range(file.metadata.num_row_groups):
                    seen = file.metadata.row_group(g).column(seq).statistics
                    if seen is not None and seen.has_min_max and (seen.max <= r["lo"] or seen.min > r["hi"]):
                        continue
                    for batch in file.iter_batches(64, row_groups=[g], columns=_leaves(file, names, fields)):
                        wanted = pc.and_(pc.greater(batch.column("seq"), r["lo"]), pc.less_equal(batch.column("seq"), r["hi"]))
                        if pc.any(wanted).as_py():
                            yield pa.RecordBatch.from_arrays([batch.column(n).filter(wanted) for n in names], names)
    return run


def ranges(spark: SparkSession, path: str, max_rows: int) -> DataFrame:
    """A stream of file ranges (path, lo, hi) over a folder of notification files; every micro-batch
    stands for the next ``max_rows`` notifications (more only where several share the last number)."""
    spark.dataSource.register(SequenceSource)
    return spark.readStream.format("notification_sequence").option("path", path).option("maxRows", max_rows).load()


def is_ranges(df: DataFrame) -> bool:
    return df.columns == ["path", "lo", "hi", "rows"]


def fetch(batch: DataFrame) -> DataFrame:
    """The notifications that one micro-batch of ranges stands for, as an ordinary scan: it prunes
    columns and pushes the range down, in a task for every ``TASK`` notifications or fewer.  One row
    per file of the batch comes to the driver."""
    rows = batch.collect()
    if not rows:
        return batch.sparkSession.createDataFrame([], schemas.NOTIFICATION)
    found = batch.sparkSession.read.schema(schemas.NOTIFICATION).parquet(*sorted({r["path"] for r in rows}))
    return found.where((F.col("seq") > rows[0]["lo"]) & (F.col("seq") <= rows[0]["hi"])).coalesce(
        max(1, -(-sum(r["rows"] for r in rows) // TASK)))


def _part(kind, fields: list):
    """The struct ``kind`` with ``fields`` (paths with dots) only."""
    wanted = {}
    for name, _, rest in (f.partition(".") for f in fields):
        wanted.setdefault(name, []).append(rest)
    if lost := set(wanted) - set(kind.names):
        raise ValueError(f"a block has no {', '.join(sorted(lost))}")
    return T.StructType([T.StructField(f.name, f.dataType if "" in wanted[f.name] else _part(f.dataType, wanted[f.name]))
                         for f in kind if f.name in wanted])


def stream(spark: SparkSession, path: str, max_rows: int, fields: list | None = None) -> DataFrame:
    """The notifications themselves as a stream, for stateful operators.  The executors read the
    ranges, one task per file and batch; of blocks only ``fields``, if there are any, such as
    ``header.number``: the scan of a stream in Python is not pruned by itself."""
    schema = schemas.NOTIFICATION
    if fields is not None:
        kind = T.ArrayType(_part(schemas.BLOCK, fields))
        schema = T.StructType([T.StructField(f.name, kind if f.name in ("old", "new") else f.dataType) for f in schema])
    return ranges(spark, path, max_rows).repartition(F.col("path")).mapInArrow(_fetch(schema.names, fields), schema)


def drain(query: StreamingQuery) -> None:
    """Wait until everything there is has been taken, in as many batches as it takes, and stop."""
    query.processAllAvailable()
    query.stop()


# executors and the planning process need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
