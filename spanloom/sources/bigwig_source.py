"""BigWig as a data source of Spark: ``spark.read.format("bigwig")``.

``register(spark)`` names it in a session. Filters on ``track_id``, ``chrom``,
``start`` and ``end`` are pushed into the scan: files of other tracks are not
opened, and the extent that the filters leave prunes the walk of the index. A file
is dealt to as many partitions as its bytes ask for, each with its share of the
blocks, so no file is opened where the query is planned.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from spanloom.sources.bigwig import RUNS, WHOLE, BigWigFile, Extents, _run_batch
from spanloom.sources.ranged import RangedFile, store

#: Bytes of a file that one partition reads, before the index is pruned.
PARTITION_BYTES = 64 << 20
#: Endings of the files.
ENDINGS = (".bw", ".bigwig")


class BigWigPartition(InputPartition):
    """A share of a file's blocks: those whose place in order leaves ``share``."""

    def __init__(self, path: str, track: str, share: int, shares: int):
        super().__init__(share)
        self.path, self.track, self.share, self.shares = path, track, share, shares


class BigWigReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        #: What the pushed filters leave: names (None: all) and an extent.
        self.tracks: set[str] | None = None
        self.chroms: set[str] | None = None
        self.low, self.high = 0, WHOLE
        # Bounds of a run's own start and end, on top of the extent.
        self.least = {"start": -WHOLE, "end": -WHOLE}
        self.most = {"start": WHOLE, "end": WHOLE}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take the filters that narrow the scan; the others go back to Spark."""
        for one in filters:
            column = one.attribute[0] if getattr(one, "attribute", None) and len(one.attribute) == 1 else None
            if column in ("track_id", "chrom") and isinstance(one, (EqualTo, In)):
                values = {one.value} if isinstance(one, EqualTo) else set(one.value)
                held = self.tracks if column == "track_id" else self.chroms
                left = values if held is None else held & values
                if column == "track_id":
                    self.tracks = left
                else:
                    self.chroms = left
            elif column in ("start", "end") and isinstance(one, (LessThan, LessThanOrEqual, GreaterThan, GreaterThanOrEqual, EqualTo)):
                if isinstance(one, (LessThan, LessThanOrEqual, EqualTo)):
                    self.most[column] = min(self.most[column], one.value - isinstance(one, LessThan))
                if isinstance(one, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.least[column] = max(self.least[column], one.value + isinstance(one, GreaterThan))
            else:
                yield one
        # A run that passes has a position at most its greatest start, and one at
        # least the place before its least end.
        self.high = max(min(self.most["start"] + 1, self.most["end"], WHOLE), 0)
        self.low = max(self.least["end"] - 1, self.least["start"], 0)

    def partitions(self) -> Sequence[InputPartition]:
        system, root = store(self.path)
        info = system.get_file_info(root)
        files = [info] if info.type == pyarrow.fs.FileType.File else system.get_file_info(pyarrow.fs.FileSelector(root))
        head = self.path.partition("://")[0] + "://" if "://" in self.path and not self.path.startswith("file:") else ""
        found = []
        for file in sorted(files, key=lambda f: f.path):
            name, dot, ending = file.base_name.rpartition(".")
            if file.type == pyarrow.fs.FileType.File and f"{dot}{ending}".lower() in ENDINGS and (self.tracks is None or name in self.tracks):
                shares = max(-(-file.size // PARTITION_BYTES), 1)
                found += [BigWigPartition(head + file.path, name, k, shares) for k in range(shares)]
        return found or [BigWigPartition("", "", 0, 0)]

    def read(self, partition: BigWigPartition) -> Iterator[pa.RecordBatch]:
        if not partition.shares:
            return
        file = BigWigFile(RangedFile(partition.path))
        names = file.chroms()
        extent = np.array([self.low]), np.array([self.high])
        wanted = Extents({number: extent for number, (name, _) in names.items() if (self.chroms is None or name in self.chroms) and self.low < self.high})
        for k, entry in enumerate(file.entries(wanted)):
            if k % partition.shares == partition.share:
                runs = _run_batch(partition.track, names, file, file.read(*entry[4:]), wanted)
                keep = np.ones(runs.num_rows, bool)
                for column in ("start", "end"):
                    places = runs.column(runs.schema.get_field_index(column)).to_numpy()
                    keep &= (places >= self.least[column]) & (places <= self.most[column])
                yield runs if keep.all() else runs.filter(pa.array(keep))


class BigWigDataSource(DataSource):
    """Runs ``track_id, chrom, start, end, value`` of a file or a folder of files."""

    @classmethod
    def name(cls) -> str:
        return "bigwig"

    def schema(self) -> str:
        return RUNS

    def reader(self, schema) -> DataSourceReader:
        return BigWigReader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BigWigDataSource)
