"""Connected components, and links inside buckets of candidates without listing all pairs."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigstat.llm.batches import cut

#: Members of a bucket that one task compares at a time with as many others.
BLOCK = 1024


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node of ``edges``; the label is the smallest node of its component.

    Large and small stars alternate until nothing changes, which takes about the logarithm of the longest chain; every
    round's edges are checkpointed. Hubs are aggregated on the map side and their joins can be split by the planner.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now, before = cut(now), None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = cut(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        now = cut(small.select("e.*").filter("u <> v").distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def blocks(members: DataFrame, bucket: list[str], member: str, payload: list[str], block: int = BLOCK) -> DataFrame:
    """One row for each pair of blocks of a bucket with two or more members: the members of both, as a list of structs.

    ``members`` has each member of a bucket once. A bucket of n members makes (n / block)^2 / 2 rows of at most about two
    blocks, so that no row grows with the bucket and every pair of members meets in some row.
    """
    dealt = members.repartition(*bucket)
    size = dealt.groupBy(*bucket).agg(F.count("*").alias("__n")).filter("__n > 1")
    parts = dealt.join(size, bucket).withColumn("__parts", F.ceil(F.col("__n") / block).cast("int"))
    own = F.pmod(F.xxhash64(member, F.lit(11)), F.col("__parts")).cast("int")
    spread = parts.select(
        *bucket, F.struct(member, *payload).alias("__m"), own.alias("__own"), F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__other"), "__parts"
    )
    # with several blocks, a pair of different blocks covers both of its own sides too
    spread = spread.filter("__parts = 1 OR __own <> __other")
    return (
        spread.groupBy(*bucket, F.least("__own", "__other").alias("__i"), F.greatest("__own", "__other").alias("__j"))
        .agg(F.collect_list("__m").alias("members"))
        .filter(F.size("members") > 1)
        .select("members")
    )


def forest(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect whatever is connected among n members; ``linked(i, others)`` says which others link to i."""
    edges, left = [], np.arange(n)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            hit = linked(one, left)
            edges += [(one, k) for k in left[hit]]
            queue += left[hit].tolist()
            left = left[~hit]
    return edges
