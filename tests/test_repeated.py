"""Tables whose rows are repeated per bin do not go through the driver."""

from pyspark.sql import functions as F

from geoloom.operators import spatial
from geoloom.operators.skew import repeated


def sent_after_repeating(df, step="Generate"):
    """Lines of the plan that repeat rows (or have another step) below a broadcast."""
    found, below = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if below is not None and depth <= below:
            below = None
        if "BroadcastExchange" in line and below is None:
            below = depth
        elif below is not None and step in line:
            found.append(line)
    return found


def test_repeated_rows_are_not_broadcast(spark):
    draw = spark.range(60).selectExpr("id AS a", "CAST(id * 7 % 60 AS DOUBLE) AS x", "CAST(id * 11 % 60 AS DOUBLE) AS y")
    right = draw.selectExpr("a AS b", "x + 3 AS x", "y + 2 AS y")
    plain = draw.join(right.withColumn("a", F.explode(F.array("b", F.col("b") + 1))).drop("x", "y"), "a")
    assert sent_after_repeating(plain)
    assert not sent_after_repeating(draw.join(repeated(right.withColumn("a", F.explode(F.array("b", F.col("b") + 1))).drop("x", "y")), "a"))
    boxes = right.selectExpr("b", "x AS x0", "y AS y0", "x + 4 AS x1", "y + 4 AS y1")
    found = {"radius": spatial.radius_join(draw, right, 10.0), "semi": spatial.semi_join_within(draw, right, 2.0), "anti": spatial.anti_join_within(draw, right, 2.0),
             "reach": spatial.reach_join(draw.withColumn("r", F.lit(5.0)), right, "r"), "pairs": spatial.pairs_within(draw, "a", 5.0),
             "box": spatial.point_box_join(draw, boxes, 10.0), "line": spatial.semi_join_near_line(draw, boxes.toDF("b", "x1", "y1", "x2", "y2"), 3.0)}
    assert {k: sent_after_repeating(d) for k, d in found.items() if sent_after_repeating(d)} == {}
    cross = draw.crossJoin(right.toDF("b", "u", "v")).withColumn("d", F.sqrt(F.expr("(x - u) * (x - u) + (y - v) * (y - v)")))
    assert found["radius"].count() == cross.filter("d <= 10").count() and found["reach"].count() == cross.filter("d <= 5").count()
    assert found["semi"].count() == cross.filter("d <= 2").select("a").distinct().count() == 60 - found["anti"].count()
