"""Tables that change all at once.

A micro-batch writes its files, then a manifest that lists them. Readers read listed
files only, so a micro-batch shows as a whole or not at all, whatever a stopped try has
left behind. Rewriting is such a change too: a new list takes the place of the old one,
then the old files go.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwatch.sources.folders import exists, folders, read_text, remove, write_text


@dataclass(frozen=True)
class Listed:
    """A committed file: the values of its partition, its micro-batch, and its path below ``rows``."""

    parts: tuple[str, ...]
    batch: str
    path: str


@dataclass
class FileLog:
    root: str
    parts: tuple[str, ...] = ("day",)
    """Partition columns; the micro-batch is one more below them."""
    every: int = 32
    """Lists are joined to one after so many micro-batches."""

    def put(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> None:
        """Write the rows of a micro-batch; they show once it is committed."""
        for left in self._folders(spark, batch_id):
            remove(spark, left)
        self._write(rows, batch_id)

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        # Large partitions are cut, small ones share a task.
        out = rows.withColumn("stream_batch", F.lit(batch_id)).hint("rebalance", *self.parts)
        out.write.mode("append").partitionBy(*self.parts, "stream_batch").parquet(f"{self.root}/rows")

    def _written(self, spark: SparkSession, batch_id: int) -> list[Listed]:
        pattern = "/".join(f"{c}=*" for c in self.parts)
        return [self._listed(f) for f in folders(spark, f"{self.root}/rows/{pattern}/stream_batch={batch_id}/*.parquet")]

    def commit(self, spark: SparkSession, batch_id: int) -> None:
        """List the files of a micro-batch: from here on readers see it."""
        write_text(spark, f"{self.root}/commits/{batch_id}", _lines(self._written(spark, batch_id)))
        if batch_id % self.every == self.every - 1:
            self._join(spark, self.files(spark), batch_id)

    def committed(self, spark: SparkSession, batch_id: int) -> bool:
        whole = self._whole(spark)
        return batch_id <= (whole[0] if whole else -1) or exists(spark, f"{self.root}/commits/{batch_id}")

    def files(self, spark: SparkSession, batch_id: int | None = None) -> list[Listed]:
        """Committed files, all or those of a micro-batch."""
        whole = self._whole(spark)
        texts = [whole[2]] if whole else []
        texts += [p for p in self._single(spark) if _number(p) > (whole[0] if whole else -1)]
        lines = [line.split("\t") for path in texts for line in read_text(spark, path).splitlines()]
        listed = [Listed(tuple(x[:-2]), x[-2], x[-1]) for x in lines]
        return [x for x in listed if batch_id is None or x.batch == str(batch_id)]

    def rows(self, spark: SparkSession, listed: Sequence[Listed], schema: T.StructType) -> DataFrame:
        """Rows of some files."""
        if not listed:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{self.root}/rows/{x.path}" for x in listed])

    def rewritten(self, spark: SparkSession, rows: DataFrame) -> list[Listed]:
        """Files of partitions written anew, for a swap; all in one write."""
        tag = -time.time_ns()
        self._write(rows, tag)
        return self._written(spark, tag)

    def swap(self, spark: SparkSession, gone: Sequence[Listed], new: Sequence[Listed]) -> None:
        """Take files off the list and put others on it, at once; then those taken off are removed."""
        if not gone and not new:
            return
        off = set(gone)
        listed = [x for x in self.files(spark) if x not in off] + list(new)
        whole = self._whole(spark)
        self._join(spark, listed, max([whole[0] if whole else -1, *map(_number, self._single(spark))]))
        for x in gone:
            remove(spark, f"{self.root}/rows/{x.path}")

    def _folders(self, spark: SparkSession, batch_id: int) -> list[str]:
        return folders(spark, f"{self.root}/rows/{'/'.join(f'{c}=*' for c in self.parts)}/stream_batch={batch_id}")

    def _listed(self, path: str) -> Listed:
        inner = path[path.index(f"/rows/{self.parts[0]}=") + len("/rows/") :]
        *values, batch = (piece.partition("=")[2] for piece in inner.split("/")[:-1])
        return Listed(tuple(values), batch, inner)

    def _single(self, spark: SparkSession) -> list[str]:
        return folders(spark, f"{self.root}/commits/[0-9]*")

    def _whole(self, spark: SparkSession) -> tuple[int, int, str] | None:
        """(last micro-batch, version, path) of the newest joined list."""
        found = []
        for path in folders(spark, f"{self.root}/commits/whole-*"):
            number, version = path.rpartition("/whole-")[2].split("-")
            found.append((int(number), int(version), path))
        return max(found, key=lambda x: (x[1], x[0]), default=None)

    def _join(self, spark: SparkSession, listed: Sequence[Listed], last: int) -> None:
        before = self._whole(spark)
        version = before[1] + 1 if before else 0
        write_text(spark, f"{self.root}/commits/whole-{last}-{version}", _lines(listed))
        for path in self._single(spark):
            if _number(path) <= last:
                remove(spark, path)
        if before:
            remove(spark, before[2])


def _number(path: str) -> int:
    return int(path.rpartition("/")[2])


def _lines(listed: Iterable[Listed]) -> str:
    return "".join("\t".join((*x.parts, x.batch, x.path)) + "\n" for x in listed)
