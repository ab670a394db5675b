"""Tables that cut lineage, in the folder that the cluster names in ``spark.checkpoint.dir``.

A written table survives lost executors and is computed once.  ``checkpoint_root`` reads the
setting from the session; only where it is unset *and* the master is local (tests) does it
make a folder of its own.  Tables live as long as the results that read them may: who knows
when that ends wraps the calls in ``temporary``; else they stay for the folder's owner to clean.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    path = f"{checkpoint_root(spark)}/millrace/{uuid.uuid4().hex}-{name}"
    written = _WRITTEN.get()
    if written is not None:
        written.append(path)
    return path


@contextmanager
def small_batches(spark: SparkSession, most: int = 4 << 20) -> Iterator[None]:
    """What runs inside goes to Python in Arrow batches of at most so many bytes (or one row), as both
    sides hold several copies of a batch.  A smaller setting stays; the session's own is put back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key, None)
    if own is None or (own.rstrip("b").isdigit() and int(own.rstrip("b")) <= most):
        yield
        return
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, own)


def _written(df: DataFrame, path: str) -> DataFrame:
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder, and read again."""
    return _written(df, new_path(df.sparkSession, name))


def delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop(df: DataFrame) -> None:
    """Delete a table that ``table`` returned and that nothing reads any more."""
    root = checkpoint_root(df.sparkSession).rpartition(":")[2].rstrip("/") + "/millrace/"
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if root in path:
            delete(df.sparkSession, path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Paths made inside, by this thread, are deleted at the end; what reads them must have been written by then.

    Yields a function like ``table`` for what is to outlive the block.
    """
    outer = _WRITTEN.get()
    held = _WRITTEN.set([])

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = new_path(spark, name)
        out = _written(df, path)
        _WRITTEN.get().remove(path)
        if outer is not None:
            outer.append(path)
        return out

    try:
        yield keep
    finally:
        for path in _WRITTEN.get():
            delete(spark, path)
        _WRITTEN.reset(held)


def unused(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name
