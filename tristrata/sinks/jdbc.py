"""Loading a delivered table into a relational database through Spark's writer."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_options(
    url: str, table: str, batch_rows: int, connections: int = 8, **more: str
) -> dict[str, str]:
    """Keep the table's definition, empty it, insert in batches.

    ``connections`` bounds the number of tasks that write at once.
    """
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "cascadeTruncate": "true",
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        **more,
    }


def load_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    """Truncate and load.  ``df`` should be a written table, so that a retried task
    repeats an insert and not the query behind it.

    The load is not atomic across tasks: a reader may see the table part filled,
    and a task lost after its commit is inserted again, which the table's primary
    key turns into an error rather than a repeat.
    """
    df.write.format("jdbc").options(**options).mode("overwrite").save()
