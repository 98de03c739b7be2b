"""Polygon areas build their edge list once."""

from pyspark.sql import functions as F

from geoloom.functions import geometry as G


def test_edges_are_built_once(spark, capsys):
    text = "[[0,0],[4,0],[4,3],[0,3]]"
    df = spark.createDataFrame([(text,), (None,), ("[]",)], "t string").repartition(2)
    ring = F.transform(F.from_json("t", "array<array<double>>"), lambda p: G.point(p[0], p[1]))
    edges = G.ring_edges(ring)  # reads its ring several times
    out, plans = df.select("t", G.signed_area(edges).alias("a")), []
    for d in (df.select(F.size(edges).alias("n")), out):
        d.explain(True)
        plans.append(capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("==")[0].count("from_json"))
    assert plans[0] == plans[1] > 0
    assert {r["t"]: r["a"] for r in out.collect()} == {text: 12.0, None: None, "[]": 0.0}
