"""How rows are spread over tasks before they are written to folders."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def gather(rows: DataFrame, folders: Sequence[str], key: Sequence[str], spread: int) -> DataFrame:
    """Bring the rows of a folder together, without putting a large folder into one task.

    Adaptive execution merges small folders and splits large ones by their actual size. Where it is off, as
    in every micro-batch, the rows of a folder go to at most `spread` tasks, chosen by `key`.
    """
    adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if adaptive and not rows.isStreaming:
        return rows.hint("rebalance", *folders)
    return rows.repartition(*folders, F.pmod(F.xxhash64(*key), F.lit(spread)))
