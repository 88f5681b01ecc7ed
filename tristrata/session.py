"""The one session every layer shares."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Nothing in the library depends on these for its results, except that text is
# turned into timestamps in the session's time zone.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above this size; a wide table's contract as
    # one generated method ran eight times slower interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # When on, building each column records where in Python it was built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "tristrata",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create the session; ``master`` stays with spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the jobs run inside; then as before."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, for tables between steps.

    Where it is unset, a local session gets a temporary folder.  On a cluster that is an
    error, as executors would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        own = spark.sparkContext.applicationId
        if own not in _OWN_FOLDERS:
            _OWN_FOLDERS[own] = tempfile.mkdtemp(prefix="tristrata-")
        folder = _OWN_FOLDERS[own]
    return folder.rstrip("/")
