"""Queries on joins, grids, demand, service and siting."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions import projection as P
from geoloom.functions import scalars as S
from geoloom.operators import demand, grids, selection, service, siting, sites, spatial
from geoloom.operators.checkpoints import materialise
from geoloom.operators.skew import spread
from geoloom.plans.fixtures import fixture, table
from geoloom.plans.jobs import siting_job
from geoloom.plans.registry import query, rounded
from geoloom.plans.selection_sql import DETECTION_TURNS, NEAR, turns

SERVICE_M, COVERAGE_M, NEAR_LINE_M, EXCLUSION_M, DC_M, BUILD_COST = 8000.0, 5000.0, 3000.0, 500.0, 1500.0, 4.0e6


def dist(a, b, ax="x", ay="y", bx="x", by="y"):
    return f"sqrt(({a}.{ax} - {b}.{bx}) * ({a}.{ax} - {b}.{bx}) + ({a}.{ay} - {b}.{by}) * ({a}.{ay} - {b}.{by}))"


def seg_dist(p, s):
    dx, dy = f"({s}.x2 - {s}.x1)", f"({s}.y2 - {s}.y1)"
    t = (f"greatest(0.0, least(1.0, coalesce((({p}.x - {s}.x1) * {dx} + ({p}.y - {s}.y1) * {dy}) / "
         f"nullif({dx} * {dx} + {dy} * {dy}, 0), 0.0)))")
    x, y = f"({p}.x - {s}.x1 - {t} * {dx})", f"({p}.y - {s}.y1 - {t} * {dy})"
    return f"sqrt({x} * {x} + {y} * {y})"


def rect_table(spark, sf):
    b = spread(fixture(spark, sf, "block_groups"), "geoid")  # its file is small, the work on its rows is not
    rings = G.rectangle(F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h"))
    return b.withColumn("rings", rings).withColumn("edges", G.edges(F.col("rings")))


def building_table(spark, sf):
    b = fixture(spark, sf, "buildings")
    rings = G.rectangle(F.col("x"), F.col("y"), F.col("x") + F.col("side"), F.col("y") + F.col("side"))
    return b.select("bld_id", "side", G.edges(rings).alias("inner_edges"))


def candidate_points(spark, sf):
    c = fixture(spark, sf, "cells")
    return c.filter("demand_kw >= 200").select(F.col("cell_id").alias("candidate_id"), "x", "y", "demand_kw", "area_id")


CANDIDATES = "SELECT cell_id AS candidate_id, x, y, demand_kw, area_id FROM fx_cells WHERE demand_kw >= 200"
PAIRS = f"""SELECT c.cell_id, 'existing' AS kind, s.sub_id, {dist('c', 's')} AS dist_m FROM fx_cells c JOIN fx_stations s
    ON {dist('c', 's')} <= {SERVICE_M} UNION ALL
    SELECT c.cell_id, 'candidate', s.candidate_id, {dist('c', 's')} FROM fx_cells c JOIN ({CANDIDATES}) s
    ON {dist('c', 's')} <= {SERVICE_M}"""
ELIGIBLE = f"""SELECT p.* FROM ({PAIRS}) p JOIN (SELECT cell_id, min(dist_m) AS m FROM ({PAIRS}) q GROUP BY cell_id) b
    ON p.cell_id = b.cell_id WHERE b.m > {COVERAGE_M} OR p.dist_m <= {COVERAGE_M}"""
# A fixed build set for the assignment queries: the candidates of one market-sized demand band.
BUILT = f"SELECT candidate_id, x, y FROM ({CANDIDATES}) k WHERE demand_kw >= 1900"
ASSIGNED = f"""SELECT cell_id, kind, sub_id, 1.0 AS frac, dist_m FROM (SELECT *, row_number() OVER (PARTITION BY cell_id
    ORDER BY dist_m, kind, sub_id) AS rn FROM ({ELIGIBLE}) e WHERE kind = 'existing' OR sub_id IN
    (SELECT candidate_id FROM ({BUILT}) b)) r WHERE rn = 1"""


def pairs_of(spark, sf):
    return service.service_pairs(fixture(spark, sf, "cells"), fixture(spark, sf, "stations"), candidate_points(spark, sf), SERVICE_M)


def eligible_of(spark, sf):
    return service.eligible_in_range(fixture(spark, sf, "cells"), fixture(spark, sf, "stations"), candidate_points(spark, sf), SERVICE_M, COVERAGE_M)


def built_of(spark, sf):
    return candidate_points(spark, sf).filter("demand_kw >= 1900").select("candidate_id", "x", "y")


def assigned_of(spark, sf):
    return materialise(service.assign_nearest_in_range(fixture(spark, sf, "cells"), fixture(spark, sf, "stations"), candidate_points(spark, sf),
                                                       built_of(spark, sf), SERVICE_M, COVERAGE_M))


METRICS = """round(sum(demand_kw * d) / sum(demand_kw), 4) AS avg_dist_m, round(max(d), 4) AS max_dist_m,
    round(avg(CASE WHEN d > 5000 THEN 100.0 ELSE 0.0 END), 4) AS gap_pct"""


@query("baseline_service_metrics", "cells stations", f"""SELECT {METRICS} FROM (SELECT c.demand_kw, min({dist('c', 's')}) AS d
    FROM fx_cells c CROSS JOIN fx_stations s GROUP BY c.cell_id, c.demand_kw) n""")
def baseline_service_metrics(spark, sf):
    out = service.baseline_service_metrics(fixture(spark, sf, "cells"), fixture(spark, sf, "stations"), gap_m=5000.0)
    return rounded(out, "avg_dist_m", "max_dist_m", "gap_pct")


@query("nearest_join", "cells stations", f"""SELECT cell_id, sub_id, round(d, 4) AS dist_m FROM (SELECT c.cell_id, s.sub_id,
    {dist('c', 's')} AS d, row_number() OVER (PARTITION BY c.cell_id ORDER BY {dist('c', 's')}, s.sub_id) AS rn
    FROM fx_cells c CROSS JOIN fx_stations s) r WHERE rn = 1""")
def nearest_join(spark, sf):
    near = spatial.nearest_join(fixture(spark, sf, "cells").select("cell_id", "x", "y"), fixture(spark, sf, "stations"), "cell_id", "sub_id")
    return rounded(near.select("cell_id", "sub_id", "dist_m"), "dist_m")


@query("radius_join", "cells stations", f"SELECT cell_id, kind, sub_id, round(dist_m, 4) AS dist_m FROM ({PAIRS}) p")
def radius_join(spark, sf):
    return rounded(pairs_of(spark, sf), "dist_m")


@query("anti_join_near_existing", "cells stations", f"""SELECT candidate_id FROM ({CANDIDATES}) k WHERE NOT EXISTS
    (SELECT 1 FROM fx_stations s WHERE {dist('k', 's')} < {EXCLUSION_M})""")
def anti_join_near_existing(spark, sf):
    return spatial.anti_join_within(candidate_points(spark, sf), fixture(spark, sf, "stations"), EXCLUSION_M,
                                    inclusive=False).select("candidate_id")


@query("semi_join_near_line", "cells segments", f"""SELECT candidate_id FROM ({CANDIDATES}) k WHERE EXISTS
    (SELECT 1 FROM fx_segments s WHERE {seg_dist('k', 's')} <= {NEAR_LINE_M})""")
def semi_join_near_line(spark, sf):
    return spatial.semi_join_near_line(candidate_points(spark, sf), fixture(spark, sf, "segments"), NEAR_LINE_M).select("candidate_id")


DC_UNCOVERED = f"""SELECT dc_id, x, y FROM fx_data_centers d WHERE sqft >= 9500 AND NOT EXISTS (SELECT 1 FROM ({CANDIDATES}) k
    WHERE {dist('d', 'k')} <= {DC_M}) AND NOT EXISTS (SELECT 1 FROM fx_stations s WHERE {dist('d', 's')} < {EXCLUSION_M})"""


@query("anti_join_uncovered", "cells stations data_centers", f"SELECT dc_id FROM ({DC_UNCOVERED}) u")
def anti_join_uncovered(spark, sf):
    return demand.uncovered_data_centers(fixture(spark, sf, "data_centers"), candidate_points(spark, sf),
                                         fixture(spark, sf, "stations"), DC_M, 9500.0).select("dc_id")


@query("filter_min_sqft", "data_centers", "SELECT dc_id, sqft FROM fx_data_centers WHERE sqft >= 9500")
def filter_min_sqft(spark, sf):
    return demand.filter_min_sqft(fixture(spark, sf, "data_centers"), 9500.0).select("dc_id", "sqft")


@query("filter_min_demand", "cells", "SELECT cell_id, demand_kw FROM fx_cells WHERE demand_kw >= 200")
def filter_min_demand(spark, sf):
    return demand.filter_min_demand(fixture(spark, sf, "cells")).select("cell_id", "demand_kw")


@query("polyline_distance_join", "cells segments", f"""SELECT c.cell_id, round(min({seg_dist('c', 's')}), 4) AS dist_m
    FROM fx_cells c CROSS JOIN fx_segments s GROUP BY c.cell_id""")
def polyline_distance_join(spark, sf):
    out = spatial.polyline_distance_join(fixture(spark, sf, "cells").select("cell_id", "x", "y"), fixture(spark, sf, "segments"), "cell_id")
    return rounded(out.select("cell_id", "dist_m"), "dist_m")


@query("self_join_dedup_pairs", "detections", f"""SELECT a.det_id AS id_a, b.det_id AS id_b, round({dist('a', 'b')}, 4) AS dist_m
    FROM (SELECT *, floor(x / 100) AS bx, floor(y / 100) AS byy FROM fx_detections) a
    JOIN (SELECT *, floor(x / 100) + ox.d AS bx, floor(y / 100) + oy.d AS byy FROM fx_detections,
    (VALUES (-1), (0), (1)) ox(d), (VALUES (-1), (0), (1)) oy(d)) b
    ON a.bx = b.bx AND a.byy = b.byy AND a.det_id < b.det_id WHERE {dist('a', 'b')} < 100""")
def self_join_dedup_pairs(spark, sf):
    return rounded(spatial.pairs_within(fixture(spark, sf, "detections"), "det_id", 100.0), "dist_m")


@query("spatial_join_within", "buildings block_groups", """SELECT b.bld_id, g.geoid FROM fx_buildings b JOIN fx_block_groups g
    ON b.x >= g.x0 AND b.x + b.side <= g.x0 + g.w AND b.y >= g.y0 AND b.y + b.side <= g.y0 + g.h""")
def spatial_join_within(spark, sf):
    return spatial.polygon_within_join(building_table(spark, sf), rect_table(spark, sf).select("geoid", F.col("edges").alias("outer_edges")),
                                       250.0).select("bld_id", "geoid")


@query("building_area_by_geoid", "buildings block_groups", """SELECT g.geoid, round(sum(b.side * b.side), 4) AS building_area_m2
    FROM fx_buildings b JOIN fx_block_groups g ON b.x >= g.x0 AND b.x + b.side <= g.x0 + g.w AND b.y >= g.y0
    AND b.y + b.side <= g.y0 + g.h GROUP BY g.geoid""")
def building_area_by_geoid(spark, sf):
    buildings = building_table(spark, sf).withColumn("area_m2", G.polygon_area(F.col("inner_edges")))
    pairs = spatial.polygon_within_join(buildings, rect_table(spark, sf).select("geoid", F.col("edges").alias("outer_edges")), 250.0)
    return rounded(demand.building_area_by_geoid(pairs, "geoid"), "building_area_m2")


@query("join_population", "block_groups", """SELECT geoid AS "GEOID", CAST(coalesce(CASE WHEN population >= 200 THEN population END, 0)
    AS INTEGER) AS population FROM fx_block_groups""")
def join_population(spark, sf):
    b = fixture(spark, sf, "block_groups")
    return demand.join_population(b.select(F.col("geoid").alias("GEOID")),
                                  b.filter("population >= 200").select(F.col("geoid").alias("GEOID"), "population"))


@query("join_building_area", "block_groups", """SELECT geoid AS "GEOID", round(coalesce(CASE WHEN population >= 200 THEN
    building_area_m2 END, 0.0), 4) AS building_area_m2 FROM fx_block_groups""")
def join_building_area(spark, sf):
    b = fixture(spark, sf, "block_groups").withColumnRenamed("geoid", "GEOID")
    return rounded(demand.join_building_area(b.select("GEOID"), b.filter("population >= 200").select("GEOID", "building_area_m2")),
                   "building_area_m2")


BOUNDS = "SELECT min(x0) AS xmin, min(y0) AS ymin, max(x0 + w) AS xmax, max(y0 + h) AS ymax FROM fx_block_groups"
GRID = f"""SELECT ix, iy, ix * rows + iy AS cell_id, xmin + ix * 3000.0 AS x0, ymin + iy * 3000.0 AS y0 FROM (SELECT *,
    CAST(ceil((ymax - ymin) / 3000.0) AS BIGINT) AS rows FROM ({BOUNDS}) b0) b,
    unnest(range(CAST(ceil((b.xmax - b.xmin) / 3000.0) AS BIGINT))) AS tx(ix), unnest(range(b.rows)) AS ty(iy)"""
OVERLAP = f"""SELECT g.cell_id, g.ix, g.iy, r.geoid, r.w * r.h AS area, r.population, r.building_area_m2,
    greatest(0, least(g.x0 + 3000.0, r.x0 + r.w) - greatest(g.x0, r.x0)) *
    greatest(0, least(g.y0 + 3000.0, r.y0 + r.h) - greatest(g.y0, r.y0)) AS overlap_m2
    FROM ({GRID}) g JOIN fx_block_groups r ON r.x0 < g.x0 + 3000.0 AND r.x0 + r.w > g.x0 AND r.y0 < g.y0 + 3000.0 AND r.y0 + r.h > g.y0"""
INTERPOLATED = f"""SELECT g.cell_id, g.ix, g.iy, coalesce(sum(o.population * o.overlap_m2 / o.area), 0.0) AS population,
    coalesce(sum(o.building_area_m2 * o.overlap_m2 / o.area), 0.0) AS building_area_m2 FROM ({GRID}) g
    LEFT JOIN ({OVERLAP}) o ON g.cell_id = o.cell_id GROUP BY g.cell_id, g.ix, g.iy"""


@query("total_bounds", "block_groups", f"SELECT round(xmin, 4) AS xmin, round(ymin, 4) AS ymin, round(xmax, 4) AS xmax, round(ymax, 4) AS ymax FROM ({BOUNDS}) b")
def total_bounds(spark, sf):
    return rounded(grids.total_bounds(rect_table(spark, sf)), "xmin", "ymin", "xmax", "ymax")


@query("make_regular_grid", "block_groups", f"""SELECT cell_id, ix, iy, round(x0, 4) AS x0, round(y0, 4) AS y0,
    round(x0 + 1500.0, 4) AS cx, round(y0 + 1500.0, 4) AS cy FROM ({GRID}) g""")
def make_regular_grid(spark, sf):
    return rounded(grids.make_regular_grid(grids.total_bounds(rect_table(spark, sf))), "x0", "y0", "cx", "cy")


@query("overlay_intersection", "block_groups", f"SELECT ix, iy, geoid, round(overlap_m2, 2) AS overlap_m2 FROM ({OVERLAP}) o WHERE overlap_m2 > 1e-3")
def overlay_intersection(spark, sf):
    r = rect_table(spark, sf)
    out = demand.overlay_intersection(r.select("geoid", "edges"), grids.total_bounds(r)).filter("overlap_m2 > 1e-3")
    return rounded(out.select("ix", "iy", "geoid", "overlap_m2"), "overlap_m2", digits=2)


@query("areal_interpolate", "block_groups", f"""SELECT cell_id, round(population, 4) AS population,
    round(building_area_m2, 4) AS building_area_m2 FROM ({INTERPOLATED}) i""")
def areal_interpolate(spark, sf):
    r = rect_table(spark, sf)
    bounds = grids.total_bounds(r)
    cells = demand.areal_interpolate(r, grids.make_regular_grid(bounds), bounds, ["population", "building_area_m2"])
    return rounded(cells.select("cell_id", "population", "building_area_m2"), "population", "building_area_m2")


@query("drop_empty_cells", "block_groups", f"""SELECT row_number() OVER (ORDER BY ix, iy) - 1 AS cell_id, ix, iy,
    round(population * 2.0 + building_area_m2 * 0.03, 4) AS demand_kw FROM ({INTERPOLATED}) i
    WHERE population * 2.0 + building_area_m2 * 0.03 > 0""")
def drop_empty_cells(spark, sf):
    return rounded(demand.build_demand_grid(rect_table(spark, sf)).select("cell_id", "ix", "iy", "demand_kw"), "demand_kw")


@query("demand_formula", "block_groups", "SELECT geoid, round(population * 2.0 + building_area_m2 * 0.03, 4) AS demand_kw FROM fx_block_groups")
def demand_formula(spark, sf):
    b = fixture(spark, sf, "block_groups")
    return b.select("geoid", F.round(demand.demand_kw(F.col("population"), F.col("building_area_m2")), 4).alias("demand_kw"))


@query("generate_candidates", "cells stations segments data_centers", f"""WITH kept AS (SELECT * FROM ({CANDIDATES}) k WHERE
    EXISTS (SELECT 1 FROM fx_segments s WHERE {seg_dist('k', 's')} <= {NEAR_LINE_M}) AND
    NOT EXISTS (SELECT 1 FROM fx_stations s WHERE {dist('k', 's')} < {EXCLUSION_M}))
    SELECT 'cell' AS source, candidate_id AS source_id, demand_kw FROM kept UNION ALL
    SELECT 'data_center', dc_id, 0.0 FROM fx_data_centers d WHERE sqft >= 9500 AND NOT EXISTS (SELECT 1 FROM kept k
    WHERE {dist('d', 'k')} <= {DC_M}) AND NOT EXISTS (SELECT 1 FROM fx_stations s WHERE {dist('d', 's')} < {EXCLUSION_M})""")
def generate_candidates(spark, sf):
    return demand.generate_candidates(
        fixture(spark, sf, "cells"), fixture(spark, sf, "stations"), fixture(spark, sf, "segments"), fixture(spark, sf, "data_centers"),
        200.0, NEAR_LINE_M, DC_M, 9500.0).select("source", "source_id", "demand_kw")


@query("eligible_pairs", "cells stations", f"SELECT cell_id, kind, sub_id, round(dist_m, 4) AS dist_m FROM ({ELIGIBLE}) e")
def eligible_pairs(spark, sf):
    return rounded(eligible_of(spark, sf), "dist_m")


EXISTING_PAIRS = f"SELECT c.cell_id, {dist('c', 's')} AS dist_m FROM fx_cells c JOIN fx_stations s ON {dist('c', 's')} <= {SERVICE_M}"


def existing_pairs(spark, sf):
    cells, stations = fixture(spark, sf, "cells"), fixture(spark, sf, "stations")
    return cells, spatial.radius_join(cells.select("cell_id", "x", "y"), stations.select("sub_id", "x", "y"), SERVICE_M)


@query("constrained_cells", "cells stations", f"""SELECT count(*) AS n_cells, round(coalesce(sum(demand_kw), 0), 4) AS demand_kw
    FROM fx_cells WHERE cell_id NOT IN (SELECT cell_id FROM ({EXISTING_PAIRS}) p WHERE dist_m <= {COVERAGE_M})""")
def constrained_cells(spark, sf):
    cells, pairs = existing_pairs(spark, sf)
    out = service.constrained_cells(cells, pairs, COVERAGE_M)
    return rounded(out.agg(F.count(F.lit(1)).alias("n_cells"), F.coalesce(F.sum("demand_kw"), F.lit(0.0)).alias("demand_kw")), "demand_kw")


@query("unreachable_check", "cells stations", f"SELECT cell_id, demand_kw FROM fx_cells WHERE cell_id IN (SELECT cell_id FROM ({PAIRS}) p)")
def unreachable_check(spark, sf):
    """Cells with demand serve themselves here, so what is out of reach holds little demand at every size; that the check refuses is tested apart."""
    cells = fixture(spark, sf, "cells")
    reached = materialise(service.reached_cells(cells, fixture(spark, sf, "stations"), candidate_points(spark, sf), SERVICE_M).select("cell_id"))
    return service.unreachable_check(cells, reached, 0.05).select("cell_id", "demand_kw")


@query("assign_nearest_open", "cells stations", f"SELECT cell_id, kind, sub_id, CAST(frac AS DOUBLE) AS frac, round(dist_m, 4) AS dist_m FROM ({ASSIGNED}) a")
def assign_nearest_open(spark, sf):
    return rounded(assigned_of(spark, sf), "dist_m")


REACHABLE = f"SELECT * FROM fx_cells WHERE cell_id IN (SELECT cell_id FROM ({PAIRS}) p WHERE dist_m <= {COVERAGE_M})"
AFTER = f"""SELECT {METRICS}, round(sum(demand_kw * d), 2) AS assignment_cost FROM (SELECT c.demand_kw, coalesce(a.dist_m * a.frac, 0.0) AS d
    FROM ({REACHABLE}) c LEFT JOIN ({ASSIGNED}) a ON c.cell_id = a.cell_id) m"""


@query("assigned_service_metrics", "cells stations", AFTER)
def assigned_service_metrics(spark, sf):
    reach = service.reached_cells(fixture(spark, sf, "cells"), fixture(spark, sf, "stations"), candidate_points(spark, sf), COVERAGE_M)
    out = service.assigned_service_metrics(reach, assigned_of(spark, sf), gap_m=5000.0)
    return rounded(rounded(out, "avg_dist_m", "max_dist_m", "gap_pct"), "assignment_cost", digits=2)


@query("assignment_objective", "cells stations", f"""SELECT round(ac, 2) AS assignment_cost, n * {BUILD_COST}E0 AS build_cost,
    round(ac + n * {BUILD_COST}, 2) AS objective FROM (SELECT sum(c.demand_kw * a.dist_m * a.frac) AS ac FROM ({ASSIGNED}) a
    JOIN fx_cells c ON a.cell_id = c.cell_id) s, (SELECT count(*) AS n FROM ({BUILT}) b) t""")
def assignment_objective(spark, sf):
    out = service.assignment_objective(fixture(spark, sf, "cells"), assigned_of(spark, sf), built_of(spark, sf), BUILD_COST)
    return rounded(out, "assignment_cost", "objective", digits=2)


PER_SUB = f"""SELECT b.candidate_id, coalesce(n, 0) AS n_cells_served, coalesce(round_even(kw, 1), 0.0) AS total_load_kw,
    coalesce(round_even(d, 0), 0.0) AS avg_service_dist_m FROM ({BUILT}) b LEFT JOIN (SELECT a.sub_id, count(*) AS n,
    sum(c.demand_kw * a.frac) AS kw, sum(a.dist_m * a.frac) / count(*) AS d FROM ({ASSIGNED}) a JOIN fx_cells c
    ON a.cell_id = c.cell_id WHERE a.kind = 'candidate' AND a.frac > 0.01 GROUP BY a.sub_id) s ON b.candidate_id = s.sub_id"""


@query("per_substation_table", "cells stations", PER_SUB)
def per_substation_table(spark, sf):
    return service.per_substation_table(built_of(spark, sf), fixture(spark, sf, "cells"), assigned_of(spark, sf)).drop("x", "y")


@query("new_coverage_area", "cells stations", f"""SELECT count(*) AS n_cells, count(*) * 9.0E0 AS new_area_km2 FROM ({ASSIGNED}) a
    WHERE kind = 'candidate' AND frac > 0.5""")
def new_coverage_area(spark, sf):
    return service.new_coverage_area(assigned_of(spark, sf))


@query("results_summary", "cells stations", f"""WITH a AS ({ASSIGNED}), reach AS ({REACHABLE}),
    m AS (SELECT {METRICS}, sum(demand_kw * d) AS cost FROM (SELECT c.demand_kw, coalesce(a.dist_m * a.frac, 0.0) AS d
        FROM reach c LEFT JOIN a ON c.cell_id = a.cell_id) q),
    b AS (SELECT {METRICS} FROM (SELECT c.demand_kw, min({dist('c', 's')}) AS d FROM reach c CROSS JOIN fx_stations s
        GROUP BY c.cell_id, c.demand_kw) q),
    f AS (SELECT count(*) AS n, coalesce(sum(demand_kw), 0.0) AS kw FROM fx_cells WHERE cell_id NOT IN (SELECT cell_id FROM reach)),
    p AS (SELECT count(*) AS n, sum(total_load_kw) AS kw FROM ({PER_SUB}) t)
    SELECT (SELECT count(*) FROM fx_stations) AS n_existing_substations, p.n AS n_new_substations,
    round(p.kw, 4) AS total_new_load_served_kw,
    (SELECT count(*) * 9.0E0 FROM a WHERE kind = 'candidate' AND frac > 0.5) AS new_coverage_area_km2,
    b.avg_dist_m AS avg_service_dist_before_m, m.avg_dist_m AS avg_service_dist_after_m,
    b.max_dist_m AS max_service_dist_before_m, m.max_dist_m AS max_service_dist_after_m,
    b.gap_pct AS coverage_gap_before_pct, m.gap_pct AS coverage_gap_after_pct, f.n AS n_transmission_constrained,
    round(f.kw, 4) AS transmission_constrained_demand_kw, round(m.cost, 2) AS assignment_cost,
    p.n * {BUILD_COST}E0 AS build_cost, round(m.cost + p.n * {BUILD_COST}, 2) AS total_objective FROM m, b, f, p""")
def results_summary(spark, sf):
    cells, stations, built = fixture(spark, sf, "cells"), fixture(spark, sf, "stations"), built_of(spark, sf)
    near = materialise(service.nearest_servers(cells, stations, candidate_points(spark, sf), SERVICE_M))
    out = service.results_summary(cells, stations, near, assigned_of(spark, sf), built, BUILD_COST, COVERAGE_M, 5000.0)
    out = rounded(out, "total_new_load_served_kw", "avg_service_dist_before_m", "avg_service_dist_after_m", "max_service_dist_before_m",
                  "max_service_dist_after_m", "coverage_gap_before_pct", "coverage_gap_after_pct", "transmission_constrained_demand_kw")
    return rounded(out, "assignment_cost", "total_objective", digits=2)


VOLTAGE_KW = """CASE sx.voltage WHEN '230000;69000' THEN 200000.0 WHEN '69000' THEN 100000.0 WHEN '500000' THEN 500000.0
    WHEN '46000' THEN 30000.0 ELSE 200000.0 END"""


@query("voltage_to_capacity", "stations", f"SELECT sub_id, CAST({VOLTAGE_KW} AS DOUBLE) AS capacity_kw FROM fx_stations sx")
def voltage_to_capacity(spark, sf):
    return fixture(spark, sf, "stations").select("sub_id", S.voltage_to_capacity(F.col("voltage")).alias("capacity_kw"))


@query("substation_capacities", "cells stations", f"""SELECT 'existing' AS kind, sub_id, CAST({VOLTAGE_KW} AS DOUBLE) AS capacity_kw FROM fx_stations sx
    UNION ALL SELECT 'candidate', candidate_id, 200000.0E0 FROM ({CANDIDATES}) k""")
def substation_capacities(spark, sf):
    return service.substation_capacities(fixture(spark, sf, "stations"), candidate_points(spark, sf))


CAPACITY = 40000.0


@query("constraint_audit", "cells stations", f"""WITH a AS ({ASSIGNED}) SELECT 'coverage' AS rule, 'cell' AS kind, cell_id AS id, -1.0E0 AS amount FROM fx_cells
    WHERE cell_id NOT IN (SELECT cell_id FROM a) UNION ALL
    SELECT 'capacity', kind, sub_id, round(kw - {CAPACITY}, 4) FROM (SELECT a.kind, a.sub_id, sum(c.demand_kw * a.frac) AS kw FROM a
    JOIN fx_cells c ON a.cell_id = c.cell_id GROUP BY a.kind, a.sub_id) l WHERE kw > {CAPACITY} UNION ALL
    SELECT 'budget', 'candidate', -1, CAST(n - 10 AS DOUBLE) FROM (SELECT count(*) AS n FROM ({BUILT}) b) t WHERE n > 10""")
def constraint_audit(spark, sf):
    cells, built = fixture(spark, sf, "cells"), built_of(spark, sf)
    capacities = service.substation_capacities(fixture(spark, sf, "stations"), candidate_points(spark, sf)).withColumn("capacity_kw", F.lit(CAPACITY))
    return rounded(service.constraint_audit(cells, assigned_of(spark, sf), built, capacities, 10), "amount")


def siting_inputs(spark, sf):
    cells = materialise(fixture(spark, sf, "cells").select("cell_id", "x", "y", "demand_kw", F.lit(0).alias("area_id")))
    eligible = materialise(service.deciding_in_range(cells, fixture(spark, sf, "stations"), candidate_points(spark, sf), SERVICE_M, COVERAGE_M))
    return cells, eligible


def greedy_sql(eligible, cells="fx_cells", limit=1000000):
    """Serial greedy, one pick per step; tables ``options, existing, state, picks``. Cover picks come first: their name sorts before the other."""
    gain = f"round(sum(o.demand_kw * (t.cur - o.dist_m)) - {BUILD_COST}, 6)"
    return f"""options AS (SELECT e.cell_id, e.sub_id, e.dist_m, c.demand_kw FROM ({eligible}) e JOIN {cells} c ON c.cell_id = e.cell_id WHERE e.kind = 'candidate'),
    existing AS (SELECT cell_id, min(dist_m) AS cur FROM ({eligible}) e WHERE kind = 'existing' GROUP BY cell_id),
    state AS (SELECT 0 AS step, d.cell_id, e.cur, CAST(NULL AS BIGINT) AS pick, '' AS phase, CAST(NULL AS DOUBLE) AS score
        FROM (SELECT DISTINCT cell_id FROM options) d LEFT JOIN existing e ON e.cell_id = d.cell_id
      UNION ALL
      SELECT s.step + 1, s.cell_id, least(s.cur, o.dist_m), b.sub_id, b.phase, b.score FROM state s
      JOIN (SELECT phase, sub_id, score FROM (
          SELECT 'cover' AS phase, o.sub_id, round(sum(o.demand_kw), 6) AS score FROM state t JOIN options o ON o.cell_id = t.cell_id
          WHERE t.cur IS NULL GROUP BY o.sub_id
          UNION ALL
          SELECT 'gain', o.sub_id, {gain} FROM state t JOIN options o ON o.cell_id = t.cell_id WHERE o.dist_m < t.cur GROUP BY o.sub_id HAVING {gain} > 0) k
        ORDER BY phase, score DESC, sub_id LIMIT 1) b ON true
      LEFT JOIN options o ON o.cell_id = s.cell_id AND o.sub_id = b.sub_id WHERE s.step < {limit}),
    picks AS (SELECT DISTINCT CAST(0 AS INTEGER) AS area_id, pick AS candidate_id, phase, CAST(step AS BIGINT) AS step, round(score, 4) AS score FROM state WHERE step > 0)"""


@query("greedy_siting", "cells stations", f"WITH RECURSIVE {greedy_sql(ELIGIBLE, limit=50)} SELECT * FROM picks")
def greedy_siting(spark, sf):
    cells, eligible = siting_inputs(spark, sf)
    return rounded(siting.greedy_siting(cells, eligible, 50, BUILD_COST), "score")


@query("budget_sweep", "cells stations", f"""WITH RECURSIVE {greedy_sql(ELIGIBLE)},
    budgets AS (SELECT unnest([10, 25, 50, 75, 100]) AS max_new),
    open AS (SELECT b.max_new, e.*, row_number() OVER (PARTITION BY b.max_new, e.cell_id ORDER BY e.dist_m, e.kind, e.sub_id) AS rn FROM ({ELIGIBLE}) e
      LEFT JOIN picks p ON e.kind = 'candidate' AND p.candidate_id = e.sub_id JOIN budgets b ON e.kind = 'existing' OR p.step <= b.max_new),
    near AS (SELECT DISTINCT cell_id FROM ({ELIGIBLE}) e WHERE dist_m <= {COVERAGE_M}),
    served AS (SELECT b.max_new, c.demand_kw, coalesce(o.dist_m, 0.0) AS d, n.cell_id IS NOT NULL AS near, coalesce(o.kind = 'candidate', false) AS new
      FROM fx_cells c CROSS JOIN budgets b LEFT JOIN (SELECT * FROM open WHERE rn = 1) o ON o.max_new = b.max_new AND o.cell_id = c.cell_id
      LEFT JOIN near n ON n.cell_id = c.cell_id),
    need AS (SELECT count(*) FILTER (phase = 'cover') AS cover, count(*) AS n FROM picks),
    metrics AS (SELECT max_new, round(100.0 * count(*) FILTER (near AND d > 5000) / count(*) FILTER (near), 4) AS coverage_gap_pct,
      round(sum(demand_kw * d) FILTER (near) / sum(demand_kw) FILTER (near), 4) AS avg_service_dist_m, round(max(d) FILTER (near), 4) AS max_service_dist_m,
      round(coalesce(sum(demand_kw) FILTER (new), 0.0), 4) AS load_shifted_kw, round(count(*) FILTER (new) * 9.0, 4) AS new_area_km2 FROM served GROUP BY max_new)
    SELECT CAST(0 AS INTEGER) AS area_id, b.max_new, CASE WHEN cover <= b.max_new THEN 'FEASIBLE' ELSE 'INFEASIBLE' END AS status,
      CASE WHEN cover <= b.max_new THEN least(n, b.max_new) END AS n_built, CASE WHEN cover <= b.max_new THEN coverage_gap_pct END AS coverage_gap_pct,
      CASE WHEN cover <= b.max_new THEN avg_service_dist_m END AS avg_service_dist_m, CASE WHEN cover <= b.max_new THEN max_service_dist_m END AS max_service_dist_m,
      CASE WHEN cover <= b.max_new THEN load_shifted_kw END AS load_shifted_kw, CASE WHEN cover <= b.max_new THEN new_area_km2 END::DOUBLE AS new_area_km2
    FROM budgets b JOIN metrics m ON m.max_new = b.max_new, need""")
def budget_sweep(spark, sf):
    cells, eligible = siting_inputs(spark, sf)
    picks = materialise(siting.greedy_siting(cells, eligible, None, BUILD_COST))
    reach = eligible.filter(F.col("dist_m") <= COVERAGE_M).select("cell_id").distinct()
    out = siting.budget_sweep(cells, eligible, reach, picks, gap_m=5000.0)
    return rounded(out, "coverage_gap_pct", "avg_service_dist_m", "max_service_dist_m", "load_shifted_kw", "new_area_km2")


JOB_BUDGET = 100
JOB_SITES = f"""SELECT candidate_id * 2 AS candidate_id, x, y FROM ({CANDIDATES}) k WHERE EXISTS (SELECT 1 FROM fx_segments s WHERE {seg_dist('k', 's')} <= {NEAR_LINE_M})
    AND NOT EXISTS (SELECT 1 FROM fx_stations s WHERE {dist('k', 's')} < {EXCLUSION_M})"""
JOB_SITES = f"""{JOB_SITES} UNION ALL SELECT dc_id * 2 + 1, x, y FROM fx_data_centers d WHERE NOT EXISTS (SELECT 1 FROM ({JOB_SITES}) k
    WHERE {dist('d', 'k')} <= {DC_M}) AND NOT EXISTS (SELECT 1 FROM fx_stations s WHERE {dist('d', 's')} < {EXCLUSION_M})"""
JOB_SQL = f"""WITH RECURSIVE sites AS ({JOB_SITES}),
    pairs AS (SELECT c.cell_id, 'existing' AS kind, s.sub_id, {dist('c', 's')} AS dist_m FROM fx_cells c JOIN fx_stations s ON {dist('c', 's')} <= {SERVICE_M}
      UNION ALL SELECT c.cell_id, 'candidate', s.candidate_id, {dist('c', 's')} FROM fx_cells c JOIN sites s ON {dist('c', 's')} <= {SERVICE_M}),
    kept AS (SELECT * FROM fx_cells WHERE cell_id IN (SELECT cell_id FROM pairs)),
    elig AS (SELECT p.* FROM pairs p JOIN (SELECT cell_id, min(dist_m) AS m FROM pairs GROUP BY cell_id) b ON p.cell_id = b.cell_id
      WHERE b.m > {COVERAGE_M} OR p.dist_m <= {COVERAGE_M}),
    {greedy_sql('SELECT * FROM elig', 'kept')},
    need AS (SELECT count(*) FILTER (phase = 'cover') <= {JOB_BUDGET} AS ok FROM picks),
    built AS (SELECT candidate_id FROM picks WHERE step <= {JOB_BUDGET}),
    a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY dist_m, kind, sub_id) AS rn FROM elig
      WHERE kind = 'existing' OR sub_id IN (SELECT candidate_id FROM built)) r WHERE rn = 1),
    reach AS (SELECT * FROM kept WHERE cell_id IN (SELECT cell_id FROM pairs WHERE dist_m <= {COVERAGE_M})),
    m AS (SELECT {METRICS}, sum(demand_kw * d) AS cost FROM (SELECT c.demand_kw, coalesce(a.dist_m, 0.0) AS d FROM reach c LEFT JOIN a ON c.cell_id = a.cell_id) q),
    b AS (SELECT {METRICS} FROM (SELECT c.demand_kw, min({dist('c', 's')}) AS d FROM reach c CROSS JOIN fx_stations s GROUP BY c.cell_id, c.demand_kw) q),
    f AS (SELECT count(*) AS n, coalesce(sum(demand_kw), 0.0) AS kw FROM kept WHERE cell_id NOT IN (SELECT cell_id FROM reach)),
    p AS (SELECT count(*) AS n, sum(kw) AS kw FROM (SELECT t.candidate_id, coalesce(round_even(sum(c.demand_kw), 1), 0.0) AS kw FROM built t
      LEFT JOIN a ON a.kind = 'candidate' AND a.sub_id = t.candidate_id LEFT JOIN kept c ON c.cell_id = a.cell_id GROUP BY t.candidate_id) t)
    SELECT CASE WHEN ok THEN 'FEASIBLE' ELSE 'INFEASIBLE' END AS status, (SELECT count(*) FROM fx_stations) AS n_existing_substations,
      CASE WHEN ok THEN p.n END AS n_new_substations, CASE WHEN ok THEN round(p.kw, 4) END AS total_new_load_served_kw,
      CASE WHEN ok THEN (SELECT count(*) * 9.0E0 FROM a WHERE kind = 'candidate') END AS new_coverage_area_km2,
      b.avg_dist_m AS avg_service_dist_before_m, CASE WHEN ok THEN m.avg_dist_m END AS avg_service_dist_after_m, b.max_dist_m AS max_service_dist_before_m,
      CASE WHEN ok THEN m.max_dist_m END AS max_service_dist_after_m, b.gap_pct AS coverage_gap_before_pct, CASE WHEN ok THEN m.gap_pct END AS coverage_gap_after_pct,
      f.n AS n_transmission_constrained, round(f.kw, 4) AS transmission_constrained_demand_kw, CASE WHEN ok THEN round(m.cost, 2) END AS assignment_cost,
      CASE WHEN ok THEN p.n * {BUILD_COST}E0 END AS build_cost, CASE WHEN ok THEN round(m.cost + p.n * {BUILD_COST}, 2) END AS total_objective FROM m, b, f, p, need"""


@query("siting_job", "cells stations segments data_centers", JOB_SQL)
def siting_job_query(spark, sf):
    out = siting_job(fixture(spark, sf, "cells").drop("area_id"), fixture(spark, sf, "stations"), fixture(spark, sf, "segments"), fixture(spark, sf, "data_centers"),
                     budget=JOB_BUDGET, radius_m=SERVICE_M, coverage_m=COVERAGE_M, build_cost=BUILD_COST, line_distance_m=NEAR_LINE_M,
                     dc_radius_m=DC_M, gap_m=5000.0)["summary"]
    out = rounded(out, "total_new_load_served_kw", "avg_service_dist_before_m", "avg_service_dist_after_m", "max_service_dist_before_m",
                  "max_service_dist_after_m", "coverage_gap_before_pct", "coverage_gap_after_pct", "transmission_constrained_demand_kw")
    return rounded(out, "assignment_cost", "total_objective", digits=2)


@query("cluster_constrained", "cells stations segments", f"""WITH RECURSIVE {turns(
    f'SELECT * FROM fx_cells WHERE cell_id NOT IN (SELECT cell_id FROM ({EXISTING_PAIRS}) p WHERE dist_m <= 3000)', 'demand_kw DESC, cell_id', f'<= {COVERAGE_M}')},
    joined AS (SELECT b.*, (SELECT min(a.n) FROM turn a WHERE {NEAR} <= {COVERAGE_M}) AS seed_n FROM ordered b),
    grouped AS (SELECT t.cell_id AS seed, count(*) AS n_cells, sum(j.demand_kw) AS total, sum(j.x * j.demand_kw) / sum(j.demand_kw) AS x,
      sum(j.y * j.demand_kw) / sum(j.demand_kw) AS y FROM joined j JOIN turn t ON t.n = j.seed_n GROUP BY t.cell_id),
    measured AS (SELECT g.*, (SELECT min({dist('g', 's')}) FROM fx_stations s) AS sub_m, (SELECT min({seg_dist('g', 's')}) FROM fx_segments s) AS tx_m FROM grouped g)
    SELECT seed, x, y, n_cells, round_even(total, 0) AS cluster_demand_kw, round_even(tx_m / 1000, 1) AS dist_to_tx_km,
      round_even(sub_m / 1000, 1) AS dist_to_sub_km, round_even(total / greatest(tx_m / 1000, 1.0), 1) AS score FROM measured""")
def cluster_constrained(spark, sf):
    cells, pairs = existing_pairs(spark, sf)
    far = materialise(service.constrained_cells(cells, pairs, 3000.0))
    return selection.cluster_constrained(far, fixture(spark, sf, "stations"), fixture(spark, sf, "segments"), COVERAGE_M)


@query("rank_expansion_clusters", "cells segments", f"""SELECT cell_id AS seed, score, cluster_demand_kw FROM (SELECT c.cell_id,
    round_even(c.demand_kw, 0) AS cluster_demand_kw, round_even(c.demand_kw / greatest(min({seg_dist('c', 's')}) / 1000, 1.0), 1) AS score
    FROM fx_cells c CROSS JOIN fx_segments s GROUP BY c.cell_id, c.demand_kw) k WHERE cluster_demand_kw >= 300
    ORDER BY score DESC, seed LIMIT 10""")
def rank_expansion_clusters(spark, sf):
    near = spatial.polyline_distance_join(fixture(spark, sf, "cells").select("cell_id", "x", "y", "demand_kw"), fixture(spark, sf, "segments"), "cell_id")
    score = F.bround(F.col("demand_kw") / F.greatest(F.col("dist_m") / 1000, F.lit(1.0)), 1)
    return selection.rank_expansion_clusters(near.select(F.col("cell_id").alias("seed"), score.alias("score"),
                                                         F.bround("demand_kw", 0).alias("cluster_demand_kw")))


@query("greedy_spaced_select", "cells", f"""WITH RECURSIVE {turns('SELECT * FROM fx_cells', 'demand_kw DESC, cell_id', '<= 3000')}
    SELECT cell_id, demand_kw FROM turn""")
def greedy_spaced_select(spark, sf):
    return selection.greedy_spaced_select(fixture(spark, sf, "cells"), "cell_id", 3000.0, [F.col("demand_kw")]).select("cell_id", "demand_kw")


@query("dedup_features", "detections", f"""WITH RECURSIVE {turns('SELECT * FROM fx_detections', 'det_id', '< 100', 'b.is_polygon OR NOT a.is_polygon')},
    met AS (SELECT a.det_id FROM turn a JOIN ordered b ON NOT a.is_polygon AND b.is_polygon AND b.n > a.n AND {NEAR} < 100
      WHERE NOT EXISTS (SELECT 1 FROM turn c WHERE c.is_polygon AND c.n < a.n AND {NEAR.replace('a.', 'c.')} < 100))
    SELECT det_id, is_polygon FROM turn WHERE det_id NOT IN (SELECT det_id FROM met)""")
def dedup_features(spark, sf):
    return selection.dedup_features(fixture(spark, sf, "detections"), "det_id").select("det_id", "is_polygon")


@query("dedup_features_priority", "detections", f"""WITH RECURSIVE {turns('SELECT * FROM fx_detections', 'is_polygon DESC, det_id', '< 100')}
    SELECT det_id, is_polygon FROM turn""")
def dedup_features_priority(spark, sf):
    return selection.dedup_features_priority(fixture(spark, sf, "detections"), "det_id").select("det_id", "is_polygon")


@query("dedup_detections", "detections", f"""WITH RECURSIVE {DETECTION_TURNS} SELECT det_id, round(mean_confidence, 4) AS mean_confidence FROM fx_detections
    WHERE NOT list_contains((SELECT gone FROM walk ORDER BY n DESC LIMIT 1), det_id)""")
def dedup_detections(spark, sf):
    return rounded(selection.dedup_detections(fixture(spark, sf, "detections"), "det_id").select("det_id", "mean_confidence"), "mean_confidence")


@query("dedup_detections_priority", "detections", f"""WITH RECURSIVE {turns('SELECT * FROM fx_detections', 'mean_confidence DESC, det_id', '<= 100')}
    SELECT det_id, round(mean_confidence, 4) AS mean_confidence FROM turn""")
def dedup_detections_priority(spark, sf):
    return rounded(selection.dedup_detections_priority(fixture(spark, sf, "detections"), "det_id").select("det_id", "mean_confidence"), "mean_confidence")


@query("random_regions", "cells", f"""WITH RECURSIVE {turns('SELECT * FROM fx_cells', 'cell_id', '< 6000')}
    SELECT cell_id, round(x - 2500, 4) AS west, round(y - 2500, 4) AS south, round(x + 2500, 4) AS east, round(y + 2500, 4) AS north
    FROM turn ORDER BY cell_id LIMIT 30""")
def random_regions(spark, sf):
    out = selection.random_regions(fixture(spark, sf, "cells"), "cell_id", 30, 2500.0, 2500.0, 6000.0)
    return rounded(out, "west", "south", "east", "north")


MATCHED = f"""SELECT cell_id AS candidate_id, min({dist('c', 's')}) AS dist_m, c.demand_kw AS total_load_kw FROM fx_cells c CROSS JOIN fx_stations s
    WHERE c.demand_kw >= 200 GROUP BY c.cell_id, c.demand_kw"""


def matched(spark, sf):
    near = spatial.nearest_join(candidate_points(spark, sf), fixture(spark, sf, "stations").select("sub_id", "x", "y"), "candidate_id", "sub_id")
    return near.select("candidate_id", "dist_m", F.col("demand_kw").alias("total_load_kw"))


@query("overlap_thresholds", "cells stations", f"""SELECT threshold_m, count(*) FILTER (WHERE dist_m <= threshold_m) AS n_within,
    round(count(*) FILTER (WHERE dist_m <= threshold_m) * 100.0 / count(*), 4) AS pct_within FROM ({MATCHED}) m,
    (VALUES (250), (500), (1000), (2000), (5000)) t(threshold_m) GROUP BY threshold_m""")
def overlap_thresholds(spark, sf):
    return rounded(service.overlap_thresholds(matched(spark, sf)), "pct_within")


@query("distance_describe", "cells stations", f"""SELECT count(*) AS n, round(avg(dist_m), 4) AS mean, round(stddev_samp(dist_m), 4) AS std,
    round(min(dist_m), 4) AS min, round(quantile_cont(dist_m, 0.25), 4) AS q25, round(quantile_cont(dist_m, 0.5), 4) AS q50,
    round(quantile_cont(dist_m, 0.75), 4) AS q75, round(max(dist_m), 4) AS max FROM ({MATCHED}) m""")
def distance_describe(spark, sf):
    return rounded(service.distance_describe(matched(spark, sf)), "mean", "std", "min", "q25", "q50", "q75", "max")


@query("flag_overlaps", "cells stations", f"SELECT candidate_id, round(dist_m, 4) AS dist_m FROM ({MATCHED}) m WHERE dist_m <= 500")
def flag_overlaps(spark, sf):
    return rounded(service.flag_overlaps(matched(spark, sf)).select("candidate_id", "dist_m"), "dist_m")


@query("urban_rural_cluster", "cells stations", f"""SELECT cluster, count(*) AS n_sites FROM (SELECT CASE WHEN dist_m / max(dist_m) OVER ()
    < total_load_kw / max(total_load_kw) OVER () THEN 'urban-like' ELSE 'rural-like' END AS cluster FROM ({MATCHED}) m) c GROUP BY cluster""")
def urban_rural_cluster(spark, sf):
    return service.urban_rural_cluster(matched(spark, sf).withColumnRenamed("dist_m", "avg_service_dist_m"))


@query("service_distance_band", "cells stations", f"""SELECT band, count(*) AS n FROM (SELECT CASE WHEN dist_m < 5000 THEN '0-5 km' WHEN dist_m < 10000 THEN '5-10 km'
    WHEN dist_m < 15000 THEN '10-15 km' WHEN dist_m < 20000 THEN '15-20 km' ELSE '20+ km' END AS band FROM ({MATCHED}) m) b GROUP BY band""")
def service_distance_band(spark, sf):
    return matched(spark, sf).groupBy(S.service_distance_band(F.col("dist_m")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


# Sites and features in degrees, for the box and name joins.
LONLAT = "-112.0 + x / 85000 AS lon, 33.0 + y / 111000 AS lat"
TAG = """CASE p_size % 5 WHEN 0 THEN 'leisure=park' WHEN 1 THEN 'natural=water' WHEN 2 THEN 'landuse=military' END"""


def restricted(spark, sf):
    dc = fixture(spark, sf, "data_centers").selectExpr("dc_id", *LONLAT.split(", "))
    tags = F.expr("""map_from_arrays(filter(array(element_at(array('leisure', 'natural', 'landuse', 'highway', 'shop'), p_size % 5 + 1), 'name'), k -> true),
        array(element_at(array('park', 'water', 'military', 'primary', 'mall'), p_size % 5 + 1), p_name))""")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("dc_id"), tags.alias("tags"))
    return sites.restricted_features(dc.join(parts, "dc_id").withColumnRenamed("dc_id", "feature_id"))


def site_points(spark, sf):
    return fixture(spark, sf, "stations").selectExpr("sub_id AS candidate_id", "x", "y", *LONLAT.split(", "))


FOUND = f"""SELECT candidate_id, list(name ORDER BY feature_id) AS names, list(type ORDER BY feature_id) AS types FROM (
    SELECT s.candidate_id, f.*, row_number() OVER (PARTITION BY s.candidate_id ORDER BY f.feature_id) AS rn FROM
    (SELECT sub_id AS candidate_id, {LONLAT} FROM fx_stations) s JOIN (SELECT d.dc_id AS feature_id, {LONLAT}, p_name AS name, {TAG} AS type
    FROM fx_data_centers d JOIN part p ON d.dc_id = p.p_partkey WHERE {TAG} IS NOT NULL) f
    ON f.lon BETWEEN s.lon - 500.0/85000 AND s.lon + 500.0/85000 AND f.lat BETWEEN s.lat - 500.0/111000 AND s.lat + 500.0/111000) r
    WHERE rn <= 3 GROUP BY candidate_id"""
SUITABILITY = """CASE WHEN f.names IS NULL THEN 'suitable' ELSE 'restricted' END AS suitability,
    CASE WHEN f.names IS NULL THEN 'No restricted areas detected within 500m' ELSE 'Near: ' || array_to_string(f.names[1:2], ', ') END AS suitability_reason,
    coalesce(array_to_string(f.types, '; '), '') AS nearby_restrictions"""


@query("site_restrictions_join", "stations data_centers", f"""SELECT s.sub_id AS candidate_id, {SUITABILITY} FROM fx_stations s LEFT JOIN ({FOUND}) f ON s.sub_id = f.candidate_id""")
def site_restrictions_join(spark, sf):
    return sites.site_restrictions_join(site_points(spark, sf).drop("x", "y"), restricted(spark, sf), "candidate_id").drop("lon", "lat")


@query("suitability_label", "stations data_centers", f"""SELECT suitability, suitability_reason, count(*) AS n FROM (SELECT {SUITABILITY} FROM fx_stations s
    LEFT JOIN ({FOUND}) f ON s.sub_id = f.candidate_id) q GROUP BY suitability, suitability_reason""")
def suitability_label(spark, sf):
    found = sites.site_restrictions(site_points(spark, sf), restricted(spark, sf), "candidate_id")
    rows = site_points(spark, sf).join(found, "candidate_id", "left")
    return rows.groupBy(S.suitability_label(F.col("restriction_names")).alias("suitability"),
                        S.suitability_reason(F.col("restriction_names")).alias("suitability_reason")).agg(F.count(F.lit(1)).alias("n"))


PLACES = f"""SELECT c.cell_id AS place_id, c.x, c.y, CASE WHEN k.c_nationkey % 3 = 0 THEN '' ELSE k.c_mktsegment END AS road,
    CASE WHEN k.c_nationkey % 4 = 0 THEN '' ELSE 'area ' || k.c_nationkey END AS neighbourhood,
    CASE WHEN k.c_nationkey % 6 = 0 THEN '' ELSE k.c_name END AS city, 'near ' || k.c_name AS display_name
    FROM fx_cells c JOIN customer k ON c.cell_id = k.c_custkey"""
NAMED = f"""SELECT candidate_id, road, city, coalesce(nullif(concat_ws(', ', nullif(road, ''), nullif(neighbourhood, ''), nullif(city, '')), ''),
    substring(display_name, 1, 80)) AS location_name FROM (SELECT s.sub_id AS candidate_id, p.*, row_number() OVER (PARTITION BY s.sub_id
    ORDER BY {dist('s', 'p')}, p.place_id) AS rn FROM fx_stations s CROSS JOIN ({PLACES}) p) r WHERE rn = 1"""


def places(spark, sf):
    k = table(spark, sf, "customer").selectExpr(
        "c_custkey AS cell_id", "CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE c_mktsegment END AS road",
        "CASE WHEN c_nationkey % 4 = 0 THEN '' ELSE concat('area ', c_nationkey) END AS neighbourhood",
        "CASE WHEN c_nationkey % 6 = 0 THEN '' ELSE c_name END AS city", "concat('near ', c_name) AS display_name")
    return fixture(spark, sf, "cells").select("cell_id", "x", "y").join(k, "cell_id").withColumnRenamed("cell_id", "place_id")


@query("nearest_place_join", "stations cells", f"SELECT candidate_id, road, city, location_name FROM ({NAMED}) n")
def nearest_place_join(spark, sf):
    return sites.nearest_place_join(site_points(spark, sf), places(spark, sf), "candidate_id").select("candidate_id", "road", "city", "location_name")


@query("location_name", "cells", f"""SELECT place_id, coalesce(nullif(concat_ws(', ', nullif(road, ''), nullif(neighbourhood, ''), nullif(city, '')), ''),
    substring(display_name, 1, 80)) AS location_name FROM ({PLACES}) p""")
def location_name(spark, sf):
    return places(spark, sf).select("place_id", S.location_name(*[F.col(c) for c in ("road", "neighbourhood", "city", "display_name")]).alias("location_name"))


@query("enrich_sites", "stations cells data_centers", f"""SELECT n.candidate_id, n.road, n.city, n.location_name, {SUITABILITY} FROM ({NAMED}) n
    LEFT JOIN ({FOUND}) f ON n.candidate_id = f.candidate_id""")
def enrich_sites(spark, sf):
    return sites.enrich_sites(site_points(spark, sf), places(spark, sf), restricted(spark, sf), "candidate_id").drop("x", "y", "lon", "lat")


@query("suitability_counts", "stations data_centers", f"""SELECT count(*) FILTER (WHERE f.names IS NULL) AS n_suitable,
    count(*) FILTER (WHERE f.names IS NOT NULL) AS n_restricted, 0 AS n_caution FROM fx_stations s LEFT JOIN ({FOUND}) f ON s.sub_id = f.candidate_id""")
def suitability_counts(spark, sf):
    from geoloom.operators.evaluate import suitability_counts as counts
    return counts(sites.site_restrictions_join(site_points(spark, sf), restricted(spark, sf), "candidate_id"))


@query("newest_item_per_point", "cells stations", """SELECT cell_id, item_id FROM (SELECT c.cell_id, o.sub_id AS item_id, row_number() OVER
    (PARTITION BY c.cell_id ORDER BY o.taken DESC, o.sub_id DESC) AS rn FROM fx_cells c JOIN (SELECT s.*, e.ts AS taken FROM fx_stations s
    JOIN events e ON s.sub_id = e.event_id WHERE year(e.ts) BETWEEN 2020 AND 2030) o
    ON c.x BETWEEN o.x - 4000 AND o.x + 4000 AND c.y BETWEEN o.y - 4000 AND o.y + 4000) r WHERE rn = 1""")
def newest_item_per_point(spark, sf):
    from geoloom.operators.sampling import newest_item_per_point as newest
    s = fixture(spark, sf, "stations").join(table(spark, sf, "events").select(F.col("event_id").alias("sub_id"), F.col("ts").alias("taken")), "sub_id")
    items = s.selectExpr("sub_id AS item_id", "x - 4000 AS x0", "y - 4000 AS y0", "x + 4000 AS x1", "y + 4000 AS y1", "taken")
    return newest(fixture(spark, sf, "cells").select("cell_id", "x", "y"), items, "cell_id", 8000.0, 2020, 2030).select("cell_id", "item_id")


@query("catalog_search", "buildings", """SELECT bld_id AS item_id, o.o_orderdate AS taken FROM fx_buildings b JOIN orders o ON b.bld_id = o.o_orderkey
    WHERE b.x <= 40000 AND b.x + side >= 10000 AND b.y <= 50000 AND b.y + side >= 20000 AND year(o.o_orderdate) BETWEEN 1995 AND 2000
    ORDER BY o.o_orderdate DESC, bld_id LIMIT 300""")
def catalog_search(spark, sf):
    from geoloom.operators.sampling import catalog_search as search, require_items
    return require_items(search(catalog(spark, sf), (10000.0, 20000.0, 40000.0, 50000.0), 1995, 2000)).select("item_id", "taken")


def catalog(spark, sf):
    b = fixture(spark, sf, "buildings").join(table(spark, sf, "orders").selectExpr("o_orderkey AS bld_id", "o_orderdate AS taken"), "bld_id")
    return b.selectExpr("bld_id AS item_id", "x AS x0", "y AS y0", "x + side AS x1", "y + side AS y1", "taken")


def utm_sql() -> str:
    """The forward series written out in SQL, with the published coefficients."""
    x, y = "eta", "xi"
    for j, a in enumerate(P._ALPHA, start=1):
        x += f" + {a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)"
        y += f" + {a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)"
    k = P.UTM_SCALE * P._RECTIFYING
    return f"""SELECT cell_id, round(500000.0E0 + {k!r} * ({x}), 3) AS utm_x, round({k!r} * ({y}), 3) AS utm_y FROM (
        SELECT cell_id, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM (
        SELECT cell_id, radians(lon + 111.0) AS lam, sinh(atanh(sin(radians(lat))) - {P._E!r} * atanh({P._E!r} * sin(radians(lat)))) AS t
        FROM (SELECT cell_id, {LONLAT} FROM fx_cells) c) p) q"""


@query("project_utm", "cells", utm_sql())
def project_utm(spark, sf):
    p = fixture(spark, sf, "cells").selectExpr("cell_id", *LONLAT.split(", ")).withColumn("p", P.project_utm(F.col("lon"), F.col("lat"), 32612))
    return rounded(p.select("cell_id", F.col("p.x").alias("utm_x"), F.col("p.y").alias("utm_y")), "utm_x", "utm_y", digits=3)


@query("unproject_utm", "cells", f"SELECT cell_id, round(lon, 7) AS lon, round(lat, 7) AS lat FROM (SELECT cell_id, {LONLAT} FROM fx_cells) c")
def unproject_utm(spark, sf):
    """There and back: the oracle is the identity."""
    p = fixture(spark, sf, "cells").selectExpr("cell_id", *LONLAT.split(", ")).withColumn("p", P.project_utm(F.col("lon"), F.col("lat"), 32612))
    p = p.withColumn("q", P.unproject_utm(F.col("p.x"), F.col("p.y"), 32612))
    return rounded(p.select("cell_id", "q.lon", "q.lat"), "lon", "lat", digits=7)


@query("project_web_mercator", "cells", f"""SELECT cell_id, round(6378137.0 * radians(lon), 3) AS mx,
    round(6378137.0 * ln(tan(pi() / 4 + radians(lat) / 2)), 3) AS my FROM (SELECT cell_id, {LONLAT} FROM fx_cells) c""")
def project_web_mercator(spark, sf):
    p = fixture(spark, sf, "cells").selectExpr("cell_id", *LONLAT.split(", ")).withColumn("p", P.project_web_mercator(F.col("lon"), F.col("lat")))
    return rounded(p.select("cell_id", F.col("p.x").alias("mx"), F.col("p.y").alias("my")), "mx", "my", digits=3)


@query("approx_metres", "cells", f"SELECT cell_id, round(lon * 85000, 4) AS mx, round(lat * 111000, 4) AS my FROM (SELECT cell_id, {LONLAT} FROM fx_cells) c")
def approx_metres(spark, sf):
    p = fixture(spark, sf, "cells").selectExpr("cell_id", *LONLAT.split(", ")).withColumn("p", P.approx_metres(F.col("lon"), F.col("lat")))
    return rounded(p.select("cell_id", F.col("p.x").alias("mx"), F.col("p.y").alias("my")), "mx", "my")


@query("buffer_point", "stations", """SELECT sub_id, 64 AS n, round(64 * 75.0 * 75.0 * sin(pi() / 32) / 2, 4) AS area_m2 FROM fx_stations""")
def buffer_point(spark, sf):
    ring = G.buffer_point(F.col("x"), F.col("y"), 75.0)
    out = fixture(spark, sf, "stations").withColumn("ring", ring).withColumn("edges", G.edges(F.col("ring")))
    return rounded(out.select("sub_id", F.size("edges").alias("n"), G.polygon_area(F.col("edges")).alias("area_m2")), "area_m2")


@query("polygon_area", "block_groups", "SELECT geoid, round(w * h, 4) AS area_m2 FROM fx_block_groups")
def polygon_area(spark, sf):
    return rounded(rect_table(spark, sf).select("geoid", G.polygon_area(F.col("edges")).alias("area_m2")), "area_m2")


@query("polygon_centroid", "block_groups", "SELECT geoid, round(x0 + w / 2, 4) AS cx, round(y0 + h / 2, 4) AS cy FROM fx_block_groups")
def polygon_centroid(spark, sf):
    p = rect_table(spark, sf).withColumn("p", G.polygon_centroid(F.col("edges")))
    return rounded(p.select("geoid", F.col("p.x").alias("cx"), F.col("p.y").alias("cy")), "cx", "cy")


@query("point_in_polygon", "block_groups", """SELECT geoid, CAST(floor(population / 40) AS BIGINT) % 2 = 0 AS inside FROM fx_block_groups""")
def point_in_polygon(spark, sf):
    """A point a quarter of the width inside or outside, by the parity of the size."""
    r = rect_table(spark, sf).withColumn("px", F.expr("CASE WHEN floor(population / 40) % 2 = 0 THEN x0 + w / 4 ELSE x0 - w / 4 END"))
    return r.select("geoid", G.point_in_polygon(F.col("edges"), F.col("px"), F.col("y0") + F.col("h") / 3).alias("inside"))


@query("polygon_within", "buildings block_groups", """SELECT g.geoid, count(b.bld_id) AS n_inside FROM fx_block_groups g LEFT JOIN fx_buildings b
    ON b.x >= g.x0 AND b.x + b.side <= g.x0 + g.w AND b.y >= g.y0 AND b.y + b.side <= g.y0 + g.h GROUP BY g.geoid""")
def polygon_within(spark, sf):
    r = rect_table(spark, sf).select("geoid", F.col("edges").alias("outer_edges"))
    n = spatial.polygon_within_join(building_table(spark, sf), r, 250.0).groupBy("geoid").agg(F.count("bld_id").alias("n_inside"))
    return r.select("geoid").join(n, "geoid", "left").withColumn("n_inside", F.coalesce("n_inside", F.lit(0)))


CLIP = (10000.0, 20000.0, 40000.0, 50000.0)
CLIP_SQL = "x0 <= 40000 AND x0 + w >= 10000 AND y0 <= 50000 AND y0 + h >= 20000"


@query("polygon_intersects_box", "block_groups", f"SELECT geoid, {CLIP_SQL} AS meets FROM fx_block_groups")
def polygon_intersects_box(spark, sf):
    return rect_table(spark, sf).select("geoid", G.polygon_intersects_box(F.col("edges"), *[F.lit(v) for v in CLIP]).alias("meets"))


@query("filter_bbox_polygons", "block_groups", f"SELECT geoid FROM fx_block_groups WHERE {CLIP_SQL}")
def filter_bbox_polygons(spark, sf):
    from geoloom.sources.readers import filter_bbox_polygons as clip
    return clip(rect_table(spark, sf), CLIP).select("geoid")


@query("filter_bbox_points", "cells", "SELECT cell_id FROM fx_cells WHERE x > 10000 AND x < 40000 AND y > 20000 AND y < 50000")
def filter_bbox_points(spark, sf):
    from geoloom.sources.readers import filter_bbox_points as inside
    return inside(fixture(spark, sf, "cells"), CLIP, "x", "y").select("cell_id")


@query("segment_distance", "stations segments", f"""SELECT s.line_id, round({seg_dist('p', 's')}, 4) AS dist_m FROM fx_segments s JOIN fx_stations p
    ON s.line_id = p.sub_id + 1""")
def segment_distance(spark, sf):
    s = fixture(spark, sf, "segments").join(fixture(spark, sf, "stations").selectExpr("sub_id + 1 AS line_id", "x", "y"), "line_id")
    return rounded(s.select("line_id", G.segment_distance(*[F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")]).alias("dist_m")), "dist_m")


@query("patch_feature_join", "stations block_groups", """SELECT p.sub_id AS patch_id, g.geoid FROM fx_stations p JOIN fx_block_groups g
    ON g.x0 <= p.x + 640 AND g.x0 + g.w >= p.x AND g.y0 <= p.y AND g.y0 + g.h >= p.y - 640""")
def patch_feature_join(spark, sf):
    from geoloom.operators.raster import patch_feature_join as join
    return join(ground_patches(spark, sf), rect_table(spark, sf).select("geoid", "edges"), "patch_id", 1500.0).select("patch_id", "geoid")


def ground_patches(spark, sf):
    """One 64x64 patch of 10 m pixels per station, upper-left corner on it."""
    return fixture(spark, sf, "stations").select(
        F.col("sub_id").alias("patch_id"), F.lit(64).alias("height"), F.lit(64).alias("width"), F.lit(10.0).alias("a"),
        F.col("x").alias("c"), F.lit(-10.0).alias("e"), F.col("y").alias("f"))


TOUCHED = """SELECT DISTINCT p.sub_id AS patch_id, r AS row, c AS col FROM fx_stations p JOIN fx_block_groups g
    ON g.x0 <= p.x + 640 AND g.x0 + g.w >= p.x AND g.y0 <= p.y AND g.y0 + g.h >= p.y - 640,
    unnest(range(64)) AS tr(r), unnest(range(64)) AS tc(c)
    WHERE g.x0 <= p.x + (c + 1) * 10.0 AND g.x0 + g.w >= p.x + c * 10.0 AND g.y0 <= p.y - r * 10.0 AND g.y0 + g.h >= p.y - (r + 1) * 10.0"""


@query("rasterize_mask", "stations block_groups", TOUCHED)
def rasterize_mask(spark, sf):
    from geoloom.operators.raster import rasterize_mask as rasterize
    return rasterize(ground_patches(spark, sf), rect_table(spark, sf).select("geoid", "edges"), "patch_id", 1500.0)


@query("positive_patch_rows", "stations block_groups", f"""SELECT patch_id, count(*) AS positive_pixels, min(row) AS mask_bbox_row_min,
    max(row) AS mask_bbox_row_max, min(col) AS mask_bbox_col_min, max(col) AS mask_bbox_col_max, 'positive' AS label
    FROM ({TOUCHED}) t GROUP BY patch_id HAVING count(*) >= 50""")
def positive_patch_rows(spark, sf):
    from geoloom.operators.raster import positive_patch_rows as rows
    out = rows(ground_patches(spark, sf), rect_table(spark, sf).select("geoid", "edges"), "patch_id", 1500.0, 10.0)
    return out.select("patch_id", "positive_pixels", "mask_bbox_row_min", "mask_bbox_row_max", "mask_bbox_col_min", "mask_bbox_col_max", "label")


@query("negative_patch_rows", "stations", """SELECT sub_id AS patch_id, 4096 AS n_pixels, 0 AS positive_pixels, 0 AS mask_sum, 'negative' AS label,
    round(sqrt(8192.0E0) * 10, 6) AS least, round(sqrt(8192.0E0) * 10, 6) AS most FROM fx_stations""")
def negative_patch_rows(spark, sf):
    from geoloom.operators.raster import array_sum, negative_patch_rows as rows
    out = rows(ground_patches(spark, sf), distance=True, resolution_m=10.0).select(
        "patch_id", F.size("mask").alias("n_pixels"), "positive_pixels", array_sum(F.col("mask")).cast("bigint").alias("mask_sum"), "label",
        F.array_min("distance").alias("least"), F.array_max("distance").alias("most"))
    return rounded(out, "least", "most", digits=6)
