"""Connected components of a distributed edge table.

Large-star and small-star steps in turn: every vertex points its larger
neighbours at the smallest one it sees, until each component is a star around
its smallest vertex. Edges never leave the executors; each round is written to
the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketseq.llm.scratch import Scratch


def _pointed(edges: DataFrame, strict: bool) -> DataFrame:
    """Rows (u, v): each v of u joined with the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    joined = edges.join(least, "u")
    if strict:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (
        joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        .where("u <> v")
    )


def star_step(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _pointed(both, strict=True).distinct()
    return _pointed(large, strict=False).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v) for each vertex u that is not the smallest v of its component.

    ``edges`` has two long columns u and v without nulls; loops and repeats do
    no harm. An empty table gives an empty table.
    """
    tidy = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current, path = scratch.write(tidy.distinct(), "edges")
    state = _fingerprint(current)
    while state[0]:
        after, after_path = scratch.write(star_step(current), "stars")
        scratch.drop(path)
        current, path, before = after, after_path, state
        state = _fingerprint(current)
        if state == before:
            break
    return current


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free sums: three numbers, whatever the size."""
    row = edges.agg(
        F.count("*"),
        F.expr("bit_xor(xxhash64(u, v))"),
        F.sum(F.expr("cast(hash(v, u) as bigint)")),
    ).first()
    return tuple(row)
