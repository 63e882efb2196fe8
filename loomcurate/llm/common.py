"""What the training-data operators share: words, shared storage, worker set-up, names."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import ready  # noqa: F401  (for the operators)

#: White space between words (fixed by the contracts): space and U+0009 to U+000D.
GAP = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Array of the words of ``text``; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: that of spark.checkpoint.dir, or in tests one of our own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="loomcurate-"))
    return sc.getCheckpointDir()


class _Table:
    """A table in the shared folder, and a weak reference to the JVM object that every plan reading it holds."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.read_by = spark, path, None

    def frame(self, schema) -> DataFrame:
        df = self.spark.read.schema(schema).parquet(self.path)
        files = df._jdf.queryExecution().analyzed().relation().location()
        self.read_by = self.spark._jvm.java.lang.ref.WeakReference(files)
        return df

    def unread(self) -> bool:
        return self.read_by is not None and self.read_by.get() is None

    def delete(self) -> bool:
        """Whether it is gone; a failure leaves it to a later attempt."""
        if self.spark.sparkContext._jsc is None:  # the session has ended; the folder is the cluster's to clean
            return True
        try:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:
            return False
        return True


_written: list[_Table] = []
_gathering: ContextVar[tuple] = ContextVar("gathering", default=())


def stored(df: DataFrame, made: list | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, short lineage, safe from lost executors.

    The table goes once the JVM has no plan left that reads it, at ``release(made)``, or when the driver's Python ends.
    """
    spark = df.sparkSession
    clean(unread_only=True)
    entry = _Table(spark, f"{shared_folder(spark)}/table-{uuid.uuid4().hex}")
    _written.append(entry)
    df.write.parquet(entry.path)
    for gathered in (made, *_gathering.get()):
        if gathered is not None:
            gathered.append(entry)
    return entry.frame(df.schema)


@contextmanager
def gathering() -> Iterator[list]:
    """A list of all tables that ``stored`` writes in the block, for ``release``."""
    made: list = []
    token = _gathering.set((*_gathering.get(), made))
    try:
        yield made
    finally:
        _gathering.reset(token)


def release(made: list) -> None:
    """Delete the tables in ``made``: only for tables that no frame handed to a caller reads."""
    for entry in made:
        if entry in _written and entry.delete():
            _written.remove(entry)
    made.clear()


@atexit.register
def clean(unread_only: bool = False) -> None:
    """Delete what ``stored`` wrote: all of it, or what no plan can read any more."""
    for entry in list(_written):
        try:
            gone = (not unread_only or entry.unread()) and entry.delete()
        except Exception:  # the JVM may be gone
            gone = False
        if gone:
            _written.remove(entry)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
