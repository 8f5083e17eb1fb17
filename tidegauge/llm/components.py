"""Connected components of links, as tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.llm.common import keep


def thinned(links, a="a", b="b"):
    """(a, b): links that join the same nodes, at most one for each node of ``b`` besides those between nodes of ``a``.

    A node of ``b`` keeps its link to the smallest node of ``a``; each other link of it goes on from that
    one. A group whose members are all linked to the same few nodes has as many links as members then,
    not a multiple.
    """
    least = F.min(a).over(Window.partitionBy(b))
    met = links.select(F.col(a), F.col(b), least.alias("least"))
    own = F.when(F.col("least") == F.col(a), F.col(b)).otherwise(F.col(a))
    return met.select(F.col("least").alias("a"), own.alias("b")).filter("a != b").distinct()


def _rooted(up):
    """(node, class) of a forest (node, class) of parents: class is the root that the parents lead to."""
    while True:
        above = up.select(F.col("node").alias("class"), F.col("class").alias("next"))
        jumped = keep(up.join(above, "class", "left").select(
            "node", F.coalesce("next", "class").alias("class"), F.col("next").isNotNull().alias("moved")),
            "classes", True)
        up = jumped.select("node", "class")
        if not jumped.filter("moved").limit(1).count():
            return up


def components(links, a="a", b="b"):
    """(node, class): the smallest node of the component, for every node of a link.

    Each round gives every node with smaller neighbours to the smallest of them, follows these parents to
    their roots and goes on with the links between different roots only. Links that lead to a parent are done, and two
    rounds at least halve the nodes, so all rounds together read a small multiple of the links. Every
    round is a written table. Hubs are reduced before the shuffle of a sum and split by skew joins.
    """
    def between(x, y, rows):
        return rows.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).filter("x != y").distinct()

    edges = keep(between("a", "b", thinned(links, a, b)), "edges", True)
    ups = []
    while not ups or edges.limit(1).count():
        up = keep(edges.groupBy(F.col("y").alias("node")).agg(F.min("x").alias("class")), "classes", True)
        roots = _rooted(up)
        other = edges.join(up, F.col("y") == F.col("node")).filter("x != class").select("x", "y")
        one, two = (roots.select(F.col("node").alias(c), F.col("class").alias(f"{c}_root")) for c in "xy")
        edges = keep(between("to", "y_root", other.join(two, "y").join(one, "x", "left").withColumn(
            "to", F.coalesce("x_root", "x"))), "edges", True)
        ups.append(roots)
    found = ups.pop()
    while ups:
        found = keep(moved(ups.pop(), found).union(found), "classes", True)
    return found.union(found.select("class").distinct().select(F.col("class").alias("node"), "class"))


def moved(classes, up):
    """``classes`` (node, class) where classes have become parts of those that ``up`` (node, class) names."""
    above = up.select(F.col("node").alias("class"), F.col("class").alias("next"))
    return classes.join(above, "class", "left").select("node", F.coalesce("next", "class").alias("class"))
