"""Session helpers: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders of the tables that were written since a ``Scratch.step`` began.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, wherever the driver has it from."""
    context = spark.sparkContext
    if getattr(context, "_quire_shipped", False):
        return
    root = Path(__file__).resolve().parent
    file = Path(tempfile.mkdtemp(prefix="quire-")) / "quire.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path(root.name) / p.relative_to(root))
    context.addPyFile(str(file))
    context._quire_shipped = True


def scratch_dir(spark: SparkSession) -> str:
    """Folder that all executors share, as named by ``spark.checkpoint.dir``.

    Only where the setting is absent and the master is a single local JVM (tests) a temporary folder is made;
    on a cluster a missing setting is an error, since a machine-local folder would be lost with its machine.
    """
    jsc = spark.sparkContext._jsc.sc()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and jsc.getCheckpointDir().isDefined():
        named = jsc.getCheckpointDir().get()
    if not named:
        if not jsc.isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.sparkContext.setCheckpointDir(named)
    return named


class Scratch:
    """Intermediate tables of one operator run, written as Parquet below the shared scratch folder.

    A written table cuts lineage and survives the loss of executors. ``drop`` removes a table that later steps
    no longer read.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        self._paths: dict[int, str] = {}

    def cut(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return the table read back, under the same schema.

        The shuffle files of the write are deleted at its end: nothing reads them again.
        """
        self.n += 1
        path = f"{self.root}/{self.n}"
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        if (made := _MADE.get()) is not None:
            made.append(path)
        return out

    def step(self, make: Callable[[], DataFrame]) -> DataFrame:
        """``cut`` of what ``make`` returns, less all tables that it and what it called had written on the way."""
        made: list[str] = []
        token = _MADE.set(made)
        try:
            df = make()
        finally:
            _MADE.reset(token)
        out = self.cut(df)
        self._delete(made)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables made by ``cut``; frames built on them can't be read afterwards."""
        self._delete([path for t in tables if (path := self._paths.pop(id(t), None))])

    def _delete(self, paths: list[str]) -> None:
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
