"""Order-dependent operators against plain serial scans, including dense spots."""

import math
import random
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.operators import components, selection, siting, skew, spatial


def points(n=160, side=900, spot=40, seed=5):
    """A third of the rows share one spot; a few are exact copies."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 4 == 0 and len(rows) < 4 * spot:
            x, y = 300 + rng.random() * 20, 300 + rng.random() * 20
        elif i % 17 == 0:
            x, y = 500.0, 500.0
        else:
            x, y = rng.random() * side, rng.random() * side
        rows.append((i, x, y, round(rng.random(), 2), rng.random() < 0.4))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, x double, y double, mean_confidence double, is_polygon boolean")


def gap(a, b):
    return math.sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def kept_features(rows, tol):
    """By definition: who takes a turn, and which points among them meet a polygon that is still there.

    A row takes a turn unless an earlier one that does is in range; points do not stop polygons.
    """
    kind = {r[0]: r[4] for r in rows}
    near = {r[0]: [s[0] for s in rows if s[0] != r[0] and gap(r, s) < tol] for r in rows}

    @lru_cache(None)
    def there(i, before):
        return not any(j < before and turn(j) and (kind[j] or not kind[i]) for j in near[i] if j < i)

    def turn(i):
        return there(i, i)
    return sorted(i for i in kind if turn(i) and not (not kind[i] and any(p > i and kind[p] and there(p, i) for p in near[i])))


def kept_detections(rows, tol):
    """By definition: a turn ends at the first more confident row still there; it removes those before that row, or else stays."""
    conf = {r[0]: r[3] for r in rows}
    near = {r[0]: sorted(s[0] for s in rows if s[0] != r[0] and gap(r, s) <= tol) for r in rows}

    @lru_cache(None)
    def there(i, before):
        return not any(j < before and removes(j, i) for j in near[i] if j < i)

    @lru_cache(None)
    def end(i):
        return min((j for j in near[i] if j > i and conf[j] > conf[i] and there(j, i)), default=math.inf)

    @lru_cache(None)
    def removes(j, i):
        return there(j, j) and i < end(j)
    return sorted(i for i in conf if there(i, i) and end(i) == math.inf)


@pytest.mark.parametrize("seed", [5, 6])
def test_serial_rules(spark, seed):
    rows = points(seed=seed)
    assert ids(selection.dedup_features(frame(spark, rows), "id")) == kept_features(rows, 100)
    assert ids(selection.dedup_detections(frame(spark, rows), "id")) == kept_detections(rows, 100)


def test_rules_hold_with_salted_bins(spark, monkeypatch):
    """The dense spot is split over salts: results must not change."""
    monkeypatch.setattr(selection, "ROWS_PER_SALT", 10)
    rows = points(n=120, seed=8)
    assert ids(selection.dedup_detections(frame(spark, rows), "id")) == kept_detections(rows, 100)
    assert ids(selection.dedup_features(frame(spark, rows), "id")) == kept_features(rows, 100)


def test_rows_without_a_position_stay(spark):
    rows = [(0, 0.0, 0.0, 0.5, True), (1, 1.0, 0.0, 0.4, False), (2, None, 5.0, 0.1, False), (3, 2.0, None, 0.1, True), (4, float("nan"), 1.0, 0.2, False)]
    for operator in (selection.dedup_features, selection.dedup_detections, selection.dedup_features_priority, selection.dedup_detections_priority):
        assert ids(operator(frame(spark, rows), "id")) == [0, 2, 3, 4]


@pytest.mark.parametrize("operator", [selection.dedup_features_priority, selection.dedup_detections])
def test_a_long_chain_takes_few_rounds(spark, monkeypatch, operator):
    rounds = []
    fewer = selection._fewer
    monkeypatch.setattr(selection, "_fewer", lambda a, b: rounds.append(b) or fewer(a, b))
    rows = [(i, 60.0 * i, 0.0, 0.5, False) for i in range(10_000)]
    assert ids(operator(frame(spark, rows), "id")) == list(range(0, 10_000, 2))
    assert len(rounds) <= 5


def test_small_tiles_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(selection, "TILE_ROWS", 40)
    monkeypatch.setattr(selection, "FIRST_TILE", 2)
    rows = points(n=140, seed=11)
    assert ids(selection.dedup_detections(frame(spark, rows), "id")) == kept_detections(rows, 100)
    assert ids(selection.dedup_features(frame(spark, rows), "id")) == kept_features(rows, 100)


def test_star_component_with_salted_centre(spark, monkeypatch):
    monkeypatch.setattr(components, "ROWS_PER_SALT", 10)
    nodes = spark.range(80).withColumnRenamed("id", "n")
    edges = spark.range(1, 60).select(F.lit(59).cast("long").alias("a"), F.col("id").alias("b"))
    got = components.connected_components(nodes, edges, "n").groupBy("component").count().filter("count > 1").collect()
    assert [(r.component, r["count"]) for r in got] == [(1, 59)]


def test_priority_rule(spark):
    rows = points(seed=7)
    kept, by_rank = [], sorted(rows, key=lambda r: (-r[3], r[0]))
    for r in by_rank:
        if all(gap(r, k) > 100 for k in kept):
            kept.append(r)
    assert ids(selection.dedup_detections_priority(frame(spark, rows), "id")) == sorted(r[0] for r in kept)


def test_boundary_distance(spark):
    pair = [(0, 0.0, 0.0, 0.5, False), (1, 100.0, 0.0, 0.5, False)]
    assert ids(selection.dedup_features(frame(spark, pair), "id")) == [0, 1]
    assert ids(selection.dedup_detections(frame(spark, pair), "id")) == [0]


def test_clusters_equal_serial(spark):
    rng = random.Random(3)
    cells = [(i, rng.random() * 60000, rng.random() * 60000, float(rng.randint(0, 30))) for i in range(120)]
    remaining, want = set(range(120)), {}
    while remaining:
        seed = max(remaining, key=lambda i: (cells[i][3], -i))
        members = [j for j in remaining if gap(cells[seed], cells[j]) <= 15000]
        want.update({j: seed for j in members})
        remaining -= set(members)
    df = spark.createDataFrame(cells, "cell_id long, x double, y double, demand_kw double")
    seeds = df.join(selection.spaced_ids(df, "cell_id", 15000.0, [F.col("demand_kw")]).select("cell_id"), "cell_id", "left_semi")
    got = selection.assign_to_seeds(df, "cell_id", seeds, 15000.0, ["demand_kw"]).select("cell_id", "seed").collect()
    assert {r.cell_id: r.seed for r in got} == want


def serial_siting(demand, edges, existing, cost):
    cur = {d: min((m for c, m in existing if c == d), default=None) for d in demand}
    cands, picks = sorted({s for _, s, _ in edges}), []
    by = {s: [(d, m) for d, t, m in edges if t == s] for s in cands}

    def best(value):
        scored = [(round(value(s), 6), -s) for s in cands]
        return max(scored) if scored else None

    reach = {d for d, _, _ in edges}
    for phase in ("cover", "gain"):
        while True:
            if phase == "cover":
                if all(cur[d] is not None for d in reach):
                    break
                score, s = best(lambda s: sum(demand[d] for d, _ in by[s] if cur[d] is None))
            else:
                score, s = best(lambda s: sum(demand[d] * max(0.0, cur[d] - m) for d, m in by[s]) - cost)
                if score <= 0:
                    break
            picks.append((-s, phase, score))
            for d, m in by[-s]:
                cur[d] = m if cur[d] is None else min(cur[d], m)
    return picks


@pytest.mark.parametrize("seed,local", [(1, 0), (2, 0), (1, 40), (2, 1_000_000)])
def test_greedy_siting_equals_serial(spark, monkeypatch, seed, local):
    """In rounds only, in rounds until few edges are live, and serially in a task."""
    monkeypatch.setattr(siting, "LOCAL_EDGES", local)
    rng = random.Random(seed)
    cells = [(i, rng.random() * 30000, rng.random() * 30000) for i in range(60)]
    demand = {i: float(rng.randint(1, 50)) for i in range(60)}
    sites = [(i, rng.random() * 30000, rng.random() * 30000) for i in range(25)]
    stations = [(i, rng.random() * 30000, rng.random() * 30000) for i in range(2)]
    near = lambda pts: [(c[0], s[0], gap(c, s)) for c in cells for s in pts if gap(c, s) <= 9000]
    edges, existing = near(sites), near(stations)
    pairs = [(d, "candidate", s, m) for d, s, m in edges] + [(d, "existing", s, m) for d, s, m in existing]
    cell_df = spark.createDataFrame([(0, i, w) for i, w in demand.items()], "area_id int, cell_id long, demand_kw double")
    pair_df = spark.createDataFrame(pairs, "cell_id long, kind string, sub_id long, dist_m double")
    want = serial_siting(demand, edges, [(d, m) for d, _, m in existing], 100000.0)
    picks = siting.greedy_siting(cell_df, pair_df, None, 100000.0)
    got = [(r.candidate_id, r.phase) for r in picks.orderBy("step").collect()]
    assert got == [(s, phase) for s, phase, _ in want]
    status = {r.max_new: r for r in siting.siting_status(cell_df, picks, [1, 100]).collect()}
    assert status[1].status == "INFEASIBLE" and status[1].n_built is None
    assert status[100].n_built == len(want)


@pytest.mark.parametrize("local", [0, 30])
def test_areas_are_sited_side_by_side(spark, monkeypatch, local):
    monkeypatch.setattr(siting, "LOCAL_EDGES", local)
    rng, cells, pairs, want = random.Random(3), [], [], {}
    for area, n in ((1, 25), (2, 6), (3, 1)):
        demand = {area * 1000 + i: float(rng.randint(0, 20)) for i in range(n)}
        edges = [(d, area * 1000 + s, rng.random() * 9000) for d in demand for s in range(8) if rng.random() < 0.4]
        existing = [(d, area, rng.random() * 9000) for d in demand if rng.random() < 0.5]
        cells += [(area, d, w) for d, w in demand.items()]
        pairs += [(d, "candidate", s, m) for d, s, m in edges] + [(d, "existing", s, m) for d, s, m in existing]
        want[area] = [(s, phase) for s, phase, _ in serial_siting(demand, edges, [(d, m) for d, _, m in existing], 20000.0)] if edges else []
    picks = siting.greedy_siting(spark.createDataFrame(cells, "area_id int, cell_id long, demand_kw double"),
                                 spark.createDataFrame(pairs, "cell_id long, kind string, sub_id long, dist_m double"), None, 20000.0)
    got = {area: [] for area in want}
    for r in picks.orderBy("area_id", "step").collect():
        got[r.area_id].append((r.candidate_id, r.phase))
    assert got == want and picks.groupBy("area_id").count().count() >= 2


def test_parts_far_apart_are_finished_without_rounds(spark, monkeypatch):
    """One area, a chain of touching bins and clusters out of reach of each other: each part fits a task, all together do not."""
    monkeypatch.setattr(siting, "LOCAL_EDGES", 500)
    rng = random.Random(4)
    spot = lambda k: (k * 60000.0 + rng.random() * 25000 - 30000, rng.random() * 25000 - 9000)
    cells, sites = ([(k * 100 + i, *spot(k)) for k in range(4) for i in range(n)] for n in (50, 25))
    stations = [(i, *spot(i % 4)) for i in range(6)]
    demand = {c[0]: float(rng.randint(1, 50)) for c in cells}
    near = lambda pts: [(c[0], s[0], gap(c, s)) for c in cells for s in pts if gap(c, s) <= 9000]
    edges, existing = near(sites), near(stations)
    assert len(edges) > 1000
    pairs = spark.createDataFrame([(d, "candidate", s, m) for d, s, m in edges] + [(d, "existing", s, m) for d, s, m in existing],
                                  "cell_id long, kind string, sub_id long, dist_m double")
    cell_df = spark.createDataFrame([(0, c[0], demand[c[0]], c[1], c[2]) for c in cells], "area_id int, cell_id long, demand_kw double, x double, y double")
    want = [(s, phase) for s, phase, _ in serial_siting(demand, edges, [(d, m) for d, _, m in existing], 100000.0)]
    assert {phase for _, phase in want} == {"cover", "gain"}

    def refuse(*args):
        raise AssertionError("a round over all parts")
    monkeypatch.setattr(siting, "_local_best", refuse)
    picks = siting.greedy_siting(cell_df, pairs, None, 100000.0)
    assert [(r.candidate_id, r.phase) for r in picks.orderBy("step").collect()] == want and picks.select("area_id").distinct().count() == 1
    monkeypatch.undo()
    monkeypatch.setattr(siting, "LOCAL_EDGES", 60)  # now in rounds, some parts ending before others
    picks = siting.greedy_siting(cell_df, pairs, None, 100000.0)
    assert [(r.candidate_id, r.phase) for r in picks.orderBy("step").collect()] == want


def test_salted_join_equals_plain(spark):
    big = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = big.join(small.filter("v > 20"), "k", how)
        salted = skew.salted_join(big, small.filter("v > 20"), ["k"], how, rows_per_salt=100)
        assert sorted(map(tuple, plain.select("id").collect())) == sorted(map(tuple, salted.select("id").collect()))


def test_running_totals_with_hot_group(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 20)).alias("g"))
    got = skew.running_totals(df, "id", {"n": F.lit(1), "s": F.col("id")}, by=["g"]).collect()
    seen = {}
    for r in sorted(got, key=lambda r: r.id):
        n, s = seen.get(r.g, (0, 0))
        seen[r.g] = (n + 1, s + r.id)
        assert (r.n, r.s) == seen[r.g]


def test_semi_and_anti_split_the_left_side(spark):
    rows = points(seed=9)
    left = frame(spark, rows).filter("id % 2 = 0")
    right = frame(spark, rows).filter("id % 2 = 1")
    l, r = [p for p in rows if p[0] % 2 == 0], [p for p in rows if p[0] % 2 == 1]
    near = sorted(p[0] for p in l if any(gap(p, q) <= 40 for q in r))
    assert ids(spatial.semi_join_within(left, right, 40.0)) == near
    assert ids(spatial.anti_join_within(left, right, 40.0)) == sorted(set(p[0] for p in l) - set(near))


def test_nearest_goes_far_and_handles_empty(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, 90000.0, 0.0)], "id long, x double, y double")
    right = spark.createDataFrame([(7, 1.0, 0.0), (5, 1.0, 0.0), (9, 40.0, 30.0)], "sid long, x double, y double")
    got = {r.id: (r.sid, r.dist_m) for r in spatial.nearest_join(left, right, "id", "sid", first_size=10.0).collect()}
    assert got[1] == (5, 1.0) and got[2][0] == 9 and got[2][1] == pytest.approx(math.hypot(89960, 30))
    none = spatial.nearest_join(left, right.limit(0), "id", "sid").collect()
    assert all(r.sid is None and r.dist_m is None for r in none)


def test_long_chain_is_one_component(spark):
    nodes = spark.range(300).withColumnRenamed("id", "n")
    edges = spark.range(299).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).filter("a <> 150")
    got = components.connected_components(nodes, edges, "n").groupBy("component").count().collect()
    assert {r.component: r["count"] for r in got} == {0: 151, 151: 149}


def test_quantiles_by_rank_equal_sorted_ones(spark):
    rng = random.Random(9)
    rows = [("hot" if i % 3 else f"g{i % 7}", rng.choice([0.0, -1.5, rng.random(), 1e300])) for i in range(900)] + [("one", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = {"low": 0.0, "a": 0.25, "b": 0.5, "c": 0.9, "high": 1.0}

    def at(values, p):
        values = sorted(values)
        k = p * (len(values) - 1)
        low, high = values[math.floor(k)], values[math.ceil(k)]
        return low if low == high else low * (math.ceil(k) - k) + high * (k - math.floor(k))
    got = {r.g: r for r in skew.exact_quantiles(df, "v", shares, ["g"]).collect()}
    groups = {g: [v for h, v in rows if h == g and v is not None] for g, _ in rows}
    assert set(got) == {g for g, v in groups.items() if v}
    for g, r in got.items():
        assert [r[k] for k in shares] == pytest.approx([at(groups[g], p) for p in shares.values()])
    whole = skew.exact_quantiles(df, "v", shares).first()
    assert [whole[k] for k in shares] == pytest.approx([at([v for _, v in rows if v is not None], p) for p in shares.values()])
    assert skew.exact_quantiles(df.limit(0), "v", shares).first().a is None


def test_pairs_are_formed_once(spark):
    rng = random.Random(10)
    points = [(i, rng.randint(0, 40) * 25.0, rng.randint(0, 40) * 25.0) for i in range(300)] + [(300 + i, 7.0, 7.0) for i in range(20)]
    df = spark.createDataFrame(points, "i int, x double, y double")
    for inclusive in (False, True):
        got = sorted((r.id_a, r.id_b) for r in spatial.pairs_within(df, "i", 100.0, inclusive).collect())
        want = sorted((a[0], b[0]) for a in points for b in points if a[0] < b[0] and (gap(a, b) <= 100 if inclusive else gap(a, b) < 100))
        assert got == want


@pytest.mark.parametrize("size", [None, 40.0, 5000.0])
def test_nearest_among_clusters_and_strays(spark, size):
    """A crowd in one spot, a few strays far away, and rows everywhere, on both sides of the axes."""
    rng = random.Random(11)
    sites = [(i, rng.gauss(0, 3), rng.gauss(0, 3)) for i in range(600)] + [(600 + i, rng.uniform(-9e4, 9e4), rng.uniform(-9e4, 9e4)) for i in range(3)]
    sites += [(700 + i, 4.0, 4.0) for i in range(80)]
    rows = [(i, rng.uniform(-1e5, 1e5), rng.uniform(-1e5, 1e5)) for i in range(200)] + [(200 + i, rng.gauss(0, 4), rng.gauss(0, 4)) for i in range(100)]
    left, right = spark.createDataFrame([*rows, (999, None, 1.0)], "i int, x double, y double"), spark.createDataFrame(sites, "s int, x double, y double")
    got = {r.i: (r.s, r.dist_m) for r in spatial.nearest_join(left, right, "i", "s", size).collect()}
    assert got.pop(999) == (None, None) and len(got) == len(rows)
    for r in rows:
        d, s = min((gap(r, s), s[0]) for s in sites)
        assert got[r[0]][0] == s and got[r[0]][1] == pytest.approx(d)


@pytest.mark.parametrize("size", [None, 15.0])
def test_nearest_segment_among_long_and_crowded_lines(spark, size):
    rng = random.Random(12)
    lines = [(rng.gauss(0, 20), rng.gauss(0, 20), rng.gauss(0, 20), rng.gauss(0, 20)) for _ in range(150)]
    lines += [(-4000.0, -3000.0, 5000.0, 4500.0), (100.0, -2000.0, 100.0, 2000.0), (-500.0, 900.0, 800.0, 900.0), (3.0, 3.0, 3.0, 3.0)]
    rows = [(i, rng.uniform(-5000, 5000), rng.uniform(-5000, 5000)) for i in range(120)] + [(120 + i, rng.gauss(0, 30), rng.gauss(0, 30)) for i in range(60)]
    got = {r.i: r.dist_m for r in spatial.polyline_distance_join(spark.createDataFrame(rows, "i int, x double, y double"), spark.createDataFrame(
        lines, "x1 double, y1 double, x2 double, y2 double"), "i", size).collect()}

    def away(x, y, x1, y1, x2, y2):
        dx, dy = x2 - x1, y2 - y1
        t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        return math.hypot(x - x1 - t * dx, y - y1 - t * dy)
    assert got == pytest.approx({i: min(away(x, y, *s) for s in lines) for i, x, y in rows})


def test_bins_of_a_long_segment_grow_with_its_length(spark):
    lines = spark.createDataFrame([(0.0, 0.0, 10000.0, 9000.0), (0.0, 5.0, 1.0, 9005.0), (3.0, 3.0, 3.0, 3.0)], "_x1 double, _y1 double, _x2 double, _y2 double")
    bins = spatial.walk_bins(lines, 10.0, 10.0, *[F.col(c) for c in lines.columns]).groupBy("_x1", "_y1").count().collect()
    assert max(r["count"] for r in bins) < 8 * 1900


def test_polygons_within_concave_ones_with_holes(spark):
    rng = random.Random(13)
    star = [(50 + (45 if k % 2 else 18) * math.cos(k * math.pi / 9), 50 + (45 if k % 2 else 18) * math.sin(k * math.pi / 9)) for k in range(18)]
    hole = [(46.0, 46.0), (46.0, 54.0), (54.0, 54.0), (54.0, 46.0)]
    square = [(0.0, 0.0), (40.0, 0.0), (40.0, 40.0), (0.0, 40.0)]
    many = [(200 + (90 + 5 * (k % 2)) * math.cos(k * math.pi / 500), 200 + (90 + 5 * (k % 2)) * math.sin(k * math.pi / 500)) for k in range(1000)]
    outer = spark.createDataFrame([(i, [[{"x": x, "y": y} for x, y in r] for r in s]) for i, s in enumerate([[star, hole], [square], [many]])],
                                  "oid int, rings array<array<struct<x:double,y:double>>>").select("oid", G.edges(F.col("rings")).alias("outer_edges"))
    boxes = [(i, rng.uniform(-5, 95), rng.uniform(-5, 95), rng.choice([1, 3, 12, 40])) for i in range(250)]
    boxes += [(300, 0.0, 0.0, 40.0), (301, 10.0, 10.0, 10.0), (302, 0.0, 30.0, 10.0)] + [(400 + i, rng.uniform(90, 310), rng.uniform(90, 310), 9) for i in range(150)]
    inner = spark.createDataFrame([(i, float(x), float(y), float(s)) for i, x, y, s in boxes], "iid int, x double, y double, s double").select(
        "iid", G.edges(G.rectangle(F.col("x"), F.col("y"), F.col("x") + F.col("s"), F.col("y") + F.col("s"))).alias("inner_edges"))
    want = sorted(map(tuple, inner.crossJoin(outer).filter(G.polygon_within(F.col("inner_edges"), F.col("outer_edges"))).select("iid", "oid").collect()))
    assert len({o for _, o in want}) == 3
    for size in (8.0, 100.0, 3000.0):
        assert sorted(map(tuple, spatial.polygon_within_join(inner, outer, size).select("iid", "oid").collect())) == want


@pytest.mark.parametrize("tile", [64, 8])
def test_duplicates_go_county_by_county(spark, monkeypatch, tile):
    """Two counties over the same ground keep what each would keep alone; NULL is a county."""
    monkeypatch.setattr(selection, "FIRST_TILE", tile)
    rng = random.Random(14)
    rows = [(i, rng.uniform(-900, 900), rng.uniform(-900, 900), rng.random() < 0.5, rng.random(), rng.choice(["a", "b", None])) for i in range(240)]
    rows += [(300, 5000.0, 0.0, True, 0.5, "a"), (301, 5000.0, 10.0, True, 0.5, "b"), (302, None, 1.0, True, 0.5, "b")]
    df = spark.createDataFrame(rows, "id int, x double, y double, is_polygon boolean, mean_confidence double, county string")
    for operator in (selection.dedup_features, selection.dedup_detections):
        got = sorted(r.id for r in operator(df, "id", by=["county"]).collect())
        alone = [operator(df.filter(F.col("county").eqNullSafe(c)), "id") for c in ("a", "b", None)]
        assert got == sorted(r.id for d in alone for r in d.collect())
        assert {300, 301, 302} <= set(got) and operator(df, "id", by=["county"]).columns == df.columns


def test_polygons_clear_of_edges_are_decided_before_python(spark, monkeypatch):
    """Only inner polygons whose part of a bin is near an edge are tallied; slanted edges are boxed inside their bin."""
    ring = [(0.0, 0.0), (90.0, 10.0), (100.0, 95.0), (5.0, 100.0)]
    outer = spark.createDataFrame([(0, [[{"x": x, "y": y} for x, y in ring]])], "oid int, rings array<array<struct<x:double,y:double>>>").select(
        "oid", G.edges(F.col("rings")).alias("outer_edges"))
    inner = spark.createDataFrame([(i, float(i % 25 * 4), float(i // 25 * 4)) for i in range(625)], "iid int, x double, y double").select(
        "iid", G.edges(G.rectangle(F.col("x"), F.col("y"), F.col("x") + 1.5, F.col("y") + 1.5)).alias("inner_edges"))
    seen = []
    tally = spatial.cover.tally
    monkeypatch.setattr(spatial.cover, "tally", lambda pairs, *a: seen.append(pairs) or tally(pairs, *a))
    got = sorted(r.iid for r in spatial.polygon_within_join(inner, outer, 10.0).collect())
    want = sorted(r.iid for r in inner.crossJoin(outer).filter(G.polygon_within(F.col("inner_edges"), F.col("outer_edges"))).select("iid").collect())
    assert got == want and 0 < sum(p.count() for p in seen) < 400


def test_newest_item_keeps_no_sorted_pairs(spark):
    """Ties go to the larger id, items out of the years are left out, and no aggregate sorts its rows."""
    import datetime as dt
    from geoloom.operators.sampling import newest_item_per_point
    day = lambda y, d: dt.datetime(y, 1, d)
    items = spark.createDataFrame([(1, 0.0, 0.0, 9.0, 9.0, day(2021, 1)), (2, 0.0, 0.0, 5.0, 5.0, day(2022, 1)), (3, 0.0, 0.0, 4.0, 4.0, day(2022, 1)),
                                   (4, 0.0, 0.0, 9.0, 9.0, day(2035, 1)), (5, 0.0, 0.0, 9.0, 9.0, None)], "item_id int, x0 double, y0 double, x1 double, y1 double, taken timestamp")
    points = spark.createDataFrame([(0, 1.0, 1.0), (1, 5.0, 5.0), (2, 8.0, 8.0), (3, 20.0, 1.0)], "p int, x double, y double")
    out = newest_item_per_point(points, items, "p", 10.0, 2020, 2030)
    assert sorted((r.p, r.item_id, r.taken) for r in out.collect()) == [(0, 3, day(2022, 1)), (1, 2, day(2022, 1)), (2, 1, day(2021, 1))]
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_radius_join_spreads_rows_of_one_file(spark):
    left = spark.range(400).selectExpr("id AS a", "CAST(id * 7 % 100 AS DOUBLE) AS x", "CAST(id % 100 AS DOUBLE) AS y").coalesce(1)
    right = spark.range(20).selectExpr("id AS b", "CAST(id * 5 AS DOUBLE) AS x", "CAST(id * 5 AS DOUBLE) AS y").coalesce(1)
    out = spatial.radius_join(left, right, 10.0)
    assert out.select(F.spark_partition_id()).distinct().count() > 1
    assert out.count() == left.crossJoin(right.toDF("b", "u", "v")).filter("sqrt((x - u) * (x - u) + (y - v) * (y - v)) <= 10").count()
