"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source gets a share of the budget (all words) by its weight; a target stops at `most` times its source's size and
what it can't take is shared again by weight among the others, until no target is above. Documents of a source are put
in an order by hash; each gets a virtual finish time, the words of its source up to and with it over the source's target.
A source that is asked for more than it has goes round again, at most `most` times. The mix is the longest beginning, in
order of finish time over all passes of all sources, that stays within the budget: what a global sort by finish time and a
cut at the budget would give, and tests hold it against that. No row is moved for it, since only the place of the cut is
needed.

No window ever holds a whole source: running sums are taken in hash ranges of bounded expected size and put together from
the ranges' totals. The cut is found range by range: by totals of fixed ranges of finish time, then of finer ranges within
the one where the budget ends, then in order, row by row, in the last. Only these few numbers reach the driver.

Null and empty texts have size 0 and are taken 0 words. Null is a source of its own, the last. Repeated rows are
documents of their own; a null doc_id is kept. Equal finish times go by source, pass, hash and doc_id; rows that agree in all
of them are taken together or not at all. If all sizes are 0, all targets are 0. An empty table gives an empty result. Very
long texts are counted whole. Other columns, whatever their names, are ignored by plan() and stay in mixed().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._graph import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Passes over a source at most.
MOST = 3
#: Rows that a hash range of a source is meant to hold.
RANGE_ROWS = 2_000
#: Ranges of finish time for each unit, units that are told apart, and finer ranges in the one where the budget ends.
COARSE, UNITS, FINE = 1024, 8, 4096
SEED = 20261126


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, rank, source_size, n, total, target for each source of sized(source, size)."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = s.withColumn("rank", rank).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")).cast("double"))
    every = Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(every))
    # water filling: sources in the order in which a rising level meets their limits
    s = s.withColumn("limit", (most * F.col("source_size")).cast("double")).withColumn("meets", F.col("limit") / F.col("weight"))
    before = Window.orderBy("meets", "rank").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0))).withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", (F.col("total") - F.col("full")) / (F.sum("weight").over(every) - F.col("gone")))
    level = F.min(F.when(F.col("meets") > F.col("level"), F.struct("meets", "rank", "level"))).over(every)["level"]
    s = s.withColumn("target", F.least("limit", F.coalesce(F.col("weight") * level, F.col("limit"))))
    return s.select("source", "rank", "source_size", "n", "total", "target")


def passes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, keep: list[str] | None = None) -> DataFrame:
    """row (a struct of docs' columns, or of those to keep), size, source_size, target and passes of each row.

    passes: how often the mix takes it. Only the columns kept are shuffled.
    """
    text = docs["text"]
    sized = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("row"), docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), size_of(text).alias("size"), F.xxhash64(F.lit(SEED), docs["doc_id"], text).bitwiseAND((1 << 63) - 1).alias("h"))
    narrow = written(sized.select("doc_id", "source", "size", "h"))
    sources = written(targets(narrow, weights, most))

    def ranged(df: DataFrame) -> DataFrame:
        """With the figures of its source, and the hash range of the source that it falls into."""
        df = df.join(sources.withColumnRenamed("source", "own"), df["source"].eqNullSafe(F.col("own"))).drop("own")
        parts = F.ceil(F.col("n") / RANGE_ROWS)
        return df.withColumn("part", F.shiftright(F.shiftright("h", 32) * parts, 31))

    totals = ranged(narrow).groupBy("rank", "part").agg(F.sum("size").alias("in_part"))
    earlier = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(totals.select("rank", "part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("start")))

    def finished(df: DataFrame) -> DataFrame:
        """With finish, the virtual finish time of each pass, in an array."""
        upto = Window.partitionBy("rank", "part").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
        df = ranged(df).join(starts, ["rank", "part"]).withColumn("upto", F.col("start") + F.sum("size").over(upto))
        times = [F.when(F.col("target") > 0, (k * F.col("source_size") + F.col("upto")) / F.col("target")) for k in range(most)]
        return df.withColumn("finish", F.array(*times))

    items = finished(narrow).where("target > 0 AND size > 0").select("rank", "h", "doc_id", "size", F.posexplode("finish").alias("k", "finish"))
    items = written(items.withColumn("coarse", F.least(F.floor(F.col("finish") * COARSE), F.lit(COARSE * UNITS))).where("finish IS NOT NULL"))
    budget = sources.agg(F.max("total")).first()[0] or 0
    fine = F.least(F.floor((F.col("finish") * COARSE - F.col("coarse")) * FINE), F.lit(FINE))

    def last(df: DataFrame, by: Column, left: int) -> tuple[int | None, int]:
        """The range in which the sum of sizes passes `left`, and what is left before it."""
        sums = df.groupBy(by.alias("at")).agg(F.sum("size").alias("size"))
        sums = sums.withColumn("upto", F.sum("size").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
        row = sums.where(F.col("upto") > left).orderBy("at").first()
        return (row["at"], left - (row["upto"] - row["size"])) if row else (None, left)

    def whole(time: Column) -> Column:
        return F.least(F.floor(time * COARSE), F.lit(COARSE * UNITS))

    coarse, left = last(items, F.col("coarse"), budget)
    key = lambda time, k: F.struct(time.alias("finish"), F.col("rank"), F.lit(k).cast("int").alias("k") if isinstance(k, int) else k.cast("int").alias("k"), F.col("h"), F.col("doc_id"))
    if coarse is None:  # all that there is
        taken = lambda time, k: F.lit(True)
    else:
        at = items.where(F.col("coarse") == coarse)
        step, left = last(at, fine, left)
        at = at.where(fine == step)
        # equal keys stand or fall together
        upto = Window.partitionBy(fine).orderBy(key(F.col("finish"), F.col("k")))
        end = at.withColumn("upto", F.sum("size").over(upto)).where(F.col("upto") <= left).agg(F.max(key(F.col("finish"), F.col("k"))).alias("key")).first()["key"]

        def taken(time: Column, k: int) -> Column:
            inner = F.least(F.floor((time * COARSE - coarse) * FINE), F.lit(FINE))
            within = inner < step
            if end is not None:
                where = [time, F.col("rank"), F.lit(k), F.col("h"), F.col("doc_id")]
                tie = F.lit(True)
                for a, b in reversed(list(zip(where, end, strict=True))):
                    tie = F.coalesce(a < b, F.lit(b is not None)) | (a.eqNullSafe(F.lit(b)) & tie)
                within = within | ((inner == step) & tie)
            return (whole(time) < coarse) | ((whole(time) == coarse) & within)

    n = sum((F.when((F.col("size") > 0) & F.coalesce(taken(F.col("finish")[k], k), F.lit(False)), 1).otherwise(0) for k in range(1, most)), F.when((F.col("size") > 0) & F.coalesce(taken(F.col("finish")[0], 0), F.lit(False)), 1).otherwise(0))
    return finished(sized).select("row", "size", "source_size", "target", n.alias("passes"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: rows of docs, as often as the mix takes them."""
    out = passes(docs, weights, most).where("passes > 0")
    return out.withColumn("pass", F.explode(F.sequence(F.lit(1), "passes"))).select("row.*")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, passes counted) and passes of every row."""
    out = passes(docs, weights, most, keep=["doc_id"])
    return out.select("row.doc_id", "size", "source_size", "target", (F.col("passes") * F.col("size")).alias("taken"), "passes")
