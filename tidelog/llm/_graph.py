"""Connected components of an edge table, tables between steps, and the most frequent rows of a table of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import scratch
from ..sources.scratch import written

__all__ = ["components", "most_frequent", "written"]

def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """node, label (the smallest node that it reaches) of every node in edges(a, b), two columns of longs.

    Alternates stars: each node's neighbours are tied to the smallest among them, first larger ones, then smaller ones,
    until nothing moves. Rows never outnumber the edges, each round is aggregated before it is shuffled, and its table is
    deleted once the next one is there. A node of very many edges is one key of the joins: they are plain inner joins of
    two longs on each side, which adaptive execution splits where such a key outgrows a task.
    """
    spark = edges.sparkSession
    kept: list[str] = []

    def stored(df: DataFrame) -> DataFrame:
        at = scratch.folder(spark)
        df.write.parquet(f"{at}/t")
        for past in kept:
            scratch.delete(spark, past)
        kept[:] = [at]
        return spark.read.schema(df.schema).parquet(f"{at}/t")

    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(rounds + 1):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        # large star: of each node's neighbours, the larger ones go to the smallest of it and them
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        e = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: the smaller ones, and the node itself, go to the smallest
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        ties = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))
        e = stored(e.join(low, "a").select(F.explode(ties).alias("x")).select("x.a", "x.b").where("a <> b").distinct())
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def most_frequent(counts: DataFrame, n: str, most: int) -> tuple[DataFrame, bool]:
    """The rows of counts with the largest n, at most `most` of them, and whether these are all.

    Whole steps of n, eight for each doubling, are taken while they fit, so only a histogram of at most 8 x 64 rows
    reaches the driver, and no task puts rows in order. Rows with n >= 1; counts is read twice.
    """
    step = F.floor(F.log2(n) * 8)
    steps = sorted(((r["step"], r["rows"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()), reverse=True)
    fit, rows = 0, 0
    while fit < len(steps) and rows + steps[fit][1] <= most:
        rows += steps[fit][1]
        fit += 1
    return counts.where(step >= steps[fit - 1][0] if fit else F.lit(False)), fit == len(steps)
