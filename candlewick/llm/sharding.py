"""Sharding documents so that groups of equal texts stay together.

Best-fit decreasing over groups: groups sorted by size enter the bin with the
tightest remaining capacity that still holds them, found in an ordered tree of
remaining capacities. Groups are placed by size class (their size to 14
significant bits, with the class's mean size, or its largest where a capacity must
hold), so the plan has a bounded number
of entries however many groups there are; a class with many groups is laid out
as runs over the rank of a group in its class.
"""

from __future__ import annotations

import bisect

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import number_rows, partitions, place_runs, stage

#: (class, size of one group, number of groups), sizes descending
Classes = list[tuple[int, float, int]]
#: (class, first rank, number of groups, bin)
Runs = list[tuple[int, int, int, int]]


def best_fit_decreasing(classes: Classes, capacity: float, bins: int | None = None) -> tuple[Runs, int] | None:
    """Place all groups in bins of ``capacity``; new bins open as needed, or
    None if more than ``bins`` would be. Groups larger than a bin get their own."""
    runs: Runs = []
    tree: list[tuple[float, int]] = []  # (remaining capacity, bin), ascending
    opened = 0
    for cls, size, n in classes:
        rank = 0
        while rank < n:
            at = bisect.bisect_left(tree, (size, -1))
            if at < len(tree):
                left, b = tree.pop(at)
            elif bins is not None and opened == bins:
                return None
            else:
                left, b = capacity, opened
                opened += 1
            k = min(n - rank, max(1, int(left // size)))
            runs.append((cls, rank, k, b))
            rank += k
            if left - k * size > 0:
                bisect.insort(tree, (left - k * size, b))
    return runs, opened


def balance(classes: Classes, bins: int) -> Runs:
    """Place all groups in exactly ``bins`` bins of nearly equal size: the least
    capacity for which best-fit decreasing needs no more bins, by bisection. A
    group above the mean of what is left has a bin to itself."""
    classes, runs, alone = [list(c) for c in classes], [], 0
    total = sum(s * n for _, s, n in classes)
    ranks = {c: 0 for c, _, _ in classes}
    while classes and alone < bins - 1 and classes[0][1] >= total / (bins - alone):
        head = classes[0]
        runs.append((head[0], ranks[head[0]], 1, alone))
        ranks[head[0]] += 1
        total -= head[1]
        head[2] -= 1
        alone += 1
        if not head[2]:
            classes.pop(0)
    rest = bins - alone
    low = total / rest
    high = low + (classes[0][1] if classes else 0) + 1
    found = best_fit_decreasing(classes, high, rest)
    while found is None:
        high *= 1.05
        found = best_fit_decreasing(classes, high, rest)
    for _ in range(24):
        if high - low <= 0.5:
            break
        mid = (low + high) / 2
        if (tried := best_fit_decreasing(classes, mid, rest)) is None:
            low = mid
        else:
            high, found = mid, tried
    return runs + [(c, ranks[c] + first, n, alone + b) for c, first, n, b in found[0]]


def shard(spark: SparkSession, docs: DataFrame, shards: int = 8, capacity: int | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, size, text_crc32, shard, slot)``.

    A row's size is its UTF-8 bytes plus one; rows with equal texts (all null
    texts count as equal) share a shard. With ``capacity``, as few shards of
    that many bytes as best-fit decreasing gives; otherwise ``shards`` shards
    of nearly equal size. ``slot`` numbers a shard's rows from 0 (repeated rows
    in any order). Other columns of ``docs`` are left out. An empty table gives
    no rows.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = stage(
        spark,
        docs.select(
            "doc_id",
            (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("")).alias("key"),
        ),
        "shard-rows",
    )
    bits = F.greatest(F.floor(F.log2(F.col("bytes").cast("double"))).cast("int") - 13, F.lit(0))
    # size class: 14 significant bits, with the number of bits dropped
    grouped = rows.groupBy("key").agg(F.sum("size").alias("bytes")).withColumn("bits", bits)
    groups = stage(
        spark,
        grouped.select("key", "bytes", F.expr("shiftright(bytes, bits) + bits * 16384L").alias("cls")),
        "shard-groups",
    )
    sizes = groups.groupBy("cls").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most"), F.count(F.lit(1)).alias("n")).collect()
    # under a capacity, a class's largest group stands for all of them
    classes = sorted(((int(r["cls"]), r["most"] if capacity else r["bytes"] / r["n"], int(r["n"])) for r in sizes), key=lambda c: (-c[1], c[0]))
    runs = best_fit_decreasing(classes, capacity)[0] if capacity else balance(classes, shards)
    runs = np.array(sorted((c << 40 | first, b) for c, first, _, b in runs) or [(0, 0)], np.int64)
    placed = place_runs(
        number_rows(groups.select("key", "cls"), ["cls"], "rank", ["key"], partitions(spark)),
        runs[:, 0], lambda run, _: {"shard": runs[run, 1].astype(np.int32)}, "shard int", ("cls", "rank"),
    ).select("key", "shard")
    return number_rows(rows.join(placed, "key"), ["shard"], "slot", ["doc_id", "key"], partitions(spark)).select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )
