"""Rows that Spark has dealt and sorted by a key, taken in a stream within a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Each batch cut where the value of a key column changes: the key and its rows.

    A key whose rows are spread over several batches comes several times in a row.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        new = np.ones(batch.num_rows, bool)
        new[1:] = False
        for k, values in zip(keys, columns):
            column = batch.column(k)
            codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        starts = np.flatnonzero(new)
        for first, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield tuple(values[first] for values in columns), batch.slice(int(first), int(end - first))


def beside(asked: DataFrame, rows: DataFrame, keys: Sequence[str], total: int, asked_rows: int, stripe_rows: int, least_stripe: int) -> DataFrame:
    """Every group of `asked` beside every stripe of `rows` of its key, dealt to tasks and sorted: `asked` first (kind 0).

    Groups of a key hold about `asked_rows` rows, stripes at most about `stripe_rows`; there are more stripes, down to
    `least_stripe` rows, where that gives all tasks something to do. A hot key is just more groups and stripes. The order
    within a group and stripe is that of vec_id.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")).join(asked.groupBy(*keys).agg(F.count("*").alias("asked")), list(keys))
    counts = counts.withColumn("groups", F.ceil(F.col("asked") / asked_rows))
    for_tasks = F.ceil(2 * tasks * F.col("n") / max(1, total) / F.col("groups"))
    stripes = F.greatest(F.ceil(F.col("n") / stripe_rows), F.least(F.ceil(F.col("n") / least_stripe), for_tasks))
    counts = counts.select(*keys, "groups", stripes.alias("stripes"))

    first = asked.join(counts, list(keys))
    first = first.withColumns({"kind": F.lit(0), "part": F.pmod(F.xxhash64("vec_id", F.lit(1)), "groups"),
                               "stripe": F.explode(F.sequence(F.lit(0).cast("long"), F.col("stripes") - 1))})
    then = rows.join(counts, list(keys))
    then = then.withColumns({"kind": F.lit(1), "stripe": F.pmod(F.xxhash64("vec_id"), "stripes"),
                             "part": F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))})
    both = first.unionByName(then, allowMissingColumns=True).drop("groups", "stripes")
    return both.repartition(tasks, *keys, "part", "stripe").sortWithinPartitions(*keys, "part", "stripe", "kind", "vec_id")
