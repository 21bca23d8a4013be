"""Tables that a plan writes once and reads back.

``settle`` writes a derived table to the shared scratch folder and reads it back. Later joins
then see its real size in bytes: Spark broadcasts it below its own threshold and otherwise
runs a sort-merge join whose hot partitions AQE splits. It also cuts the lineage, and the
files survive the loss of any executor.

The folder is ``spark.checkpoint.dir`` of the session, in every mode. Only a local session
without that setting gets one here: a folder in its warehouse. All tables of an application
lie in one folder below it, which ``clear`` removes once the results are written.

A plan of many steps owns its tables with ``scope``: when the block ends, all tables settled in it
are deleted but those made by ``keep``, which belong to the scope around it, if any.

    with scope(spark) as keep:
        cuts = settle(...)
        result = keep(rows.join(cuts, ...))     # written while its inputs are there
    return result
"""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Paths of the tables settled in each open scope, the innermost last.
_scopes: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set(SETTING, root)
    return f"{root.rstrip('/')}/loopweave-{spark.sparkContext.applicationId}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the scratch folder and return the table that was written."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    if _scopes.get():
        _scopes.get()[-1].append(path)  # also if writing fails half-way
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables settled in the block are deleted at its end; the function it gives settles a table that stays.

    Whatever leaves the block must be such a table, or be made from such tables.
    """
    outer, own = _scopes.get(), []
    token = _scopes.set((*outer, own))

    def keep(df: DataFrame) -> DataFrame:
        inside = _scopes.set(outer)
        try:
            return settle(df)
        finally:
            _scopes.reset(inside)

    try:
        yield keep
    finally:
        _scopes.reset(token)
        for path in own:
            _delete(spark, path)


@contextlib.contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables settled in the block; nothing is deleted. For ``drop``, once nobody reads them any more."""
    own: list[str] = []
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield own
    finally:
        _scopes.reset(token)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Deletes settled tables by the paths that ``recorded`` gave, and empties the list."""
    while paths:
        _delete(spark, paths.pop())


def _delete(spark: SparkSession, name: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Removes the settled tables of this application; DataFrames over them can't be read after that."""
    _delete(spark, scratch_root(spark))
