"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitrec.llm.joins import share, spread
from sitrec.storage import written

TASK_ROWS, TASKS = 1 << 14, 8  # rows of a few numbers for a task, and the fewest tasks


def gathered(rows: int) -> int:
    """Tasks that a step over so many ``rows`` of a few numbers is gathered into; more than there are change nothing."""
    return max(TASKS, -(-rows // TASK_ROWS))


def _stars(edges: DataFrame, large: bool, limit: int, tasks: int) -> DataFrame:
    """One step: every node ties its larger (or not larger) neighbours to the smallest of them all.

    A centre with more than ``limit`` neighbours is divided.
    """
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")).coalesce(tasks)
    centres = least.select("u", F.col("n").alias("_n")).where(F.col("_n") > limit)
    joined = spread(both, least.drop("n"), (centres, limit), ["u"]).coalesce(tasks)
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct().coalesce(tasks)


def _small_stars(edges: DataFrame, tasks: int) -> DataFrame:
    """Both steps for a table whose nodes have few neighbours: each node's rows meet once a step, unjoined."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = F.min("v").over(Window.partitionBy("u"))
    large = both.select("u", "v", F.least(least, "u").alias("m")).coalesce(tasks).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    small = large.select("u", "v", least.alias("m")).coalesce(tasks)
    # the row of the smallest neighbour becomes the node's own edge, every other row its neighbour's
    tied = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return small.select(tied.alias("u"), F.col("m").alias("v")).distinct().coalesce(tasks)


def _shape(edges: DataFrame, tasks: int) -> tuple[int, bool]:
    """The most neighbours a node has, and whether all nodes but the smallest of a component have it as their only one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n")).coalesce(tasks)
    most, tangled = nodes.agg(F.max("n"), F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("n") > F.col("up"))))).first()
    return most or 0, not tangled


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``u, v``; the root is the component's smallest node.

    Each round is written, so a lost executor costs one round at most.  The number of rounds grows with
    the logarithm of the largest component; a node's edges are summed up before they move, unless all nodes have few.
    ``edges`` is read more than once: it should be a written table.  A round has as many tasks as its edges fill: the edges
    of a small table are not dealt over all shuffle partitions, each with a task and files of its own, again and again.
    """
    table = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    count = table.count()  # stars do not add edges
    limit, tasks = share(2 * count), gathered(2 * count)
    while True:
        most, done = _shape(table, tasks)
        if done:
            return table.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                table.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct().coalesce(tasks)
            )
        stars = _small_stars(table, tasks) if most <= limit else _stars(_stars(table, True, limit, tasks), False, limit, tasks)
        table = written(stars, "edges")
