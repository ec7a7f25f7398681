"""Intermediate tables in the folder that driver and executors share.

A written table cuts the lineage and survives the loss of any executor.  The
folder is the one the session names in ``spark.checkpoint.dir``; only a
``local[...]`` session without that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLED = "merge"  # hint of joins whose sides grow with the input: neither is collected and broadcast, whatever its files suggest
_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the session.

    Raises ``ValueError`` on a cluster that names none: a folder of one
    machine would be invisible to the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="quillon-")
    return _own_folder[app]


class Scratch:
    """Writes tables to the shared folder and removes those no longer needed.

    ``opened`` lists all that this process has made, the latest last.
    """

    opened: list[Scratch] = []

    def __init__(self, spark: SparkSession):
        Scratch.opened.append(self)
        self.spark = spark
        self.base = f"{shared_folder(spark)}/quillon-{uuid.uuid4().hex}"
        self.count = 0

    def save(self, df: DataFrame, batch_rows: int | None = None, by: str | None = None) -> DataFrame:
        """Write ``df`` and return the reread table.

        ``batch_rows`` bounds the rows that go to Python at once, for wide rows; ``by`` names
        a column whose values get folders of their own.
        """
        self.count += 1
        path = f"{self.base}/{self.count}"
        before = self.spark.conf.get(BATCH)
        if batch_rows:
            self.spark.conf.set(BATCH, str(min(batch_rows, int(before) if int(before) > 0 else batch_rows)))
        try:
            (df.write.partitionBy(by) if by else df.write).parquet(path)
        finally:
            if batch_rows:
                self.spark.conf.set(BATCH, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._quillon_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that ``save`` returned."""
        for table in tables:
            self._delete(table._quillon_path)

    def keep_only(self, *tables: DataFrame) -> None:
        """Remove all tables but those given, which ``save`` returned."""
        kept = {t._quillon_path for t in tables}
        for n in range(1, self.count + 1):
            if f"{self.base}/{n}" not in kept:
                self._delete(f"{self.base}/{n}")

    def remove(self) -> None:
        """Remove all tables; none may be read afterwards."""
        self._delete(self.base)

    def _delete(self, path: str) -> None:
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(found, True)
