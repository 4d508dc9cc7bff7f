"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.plans.materialize import discard, materialize


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang each vertex's larger (or own smaller) neighbours on its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(least, "u")
    out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger:
        out = hung.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (u, v); component is the smallest vertex that it reaches.

    Large-star and small-star rounds (a logarithmic number of them) end when a round changes nothing. Each round is written to
    the shared folder, so that a lost executor costs one round at most; nothing but a count and a checksum reaches the driver.
    """
    current = materialize(edges.where("u != v AND u IS NOT NULL AND v IS NOT NULL").select("u", "v").distinct(), "edges")
    seen = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark[0] == 0 or tuple(mark) == seen:
            break
        seen = tuple(mark)
        after = materialize(_stars(_stars(current, True), False), "edges")
        discard(current)
        current = after
    members = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("id"), "component").distinct())
