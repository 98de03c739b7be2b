"""Demand grid by areal interpolation and candidate sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.operators import spatial
from geoloom.operators.grids import make_regular_grid, total_bounds

CELL_SIZE_M = 3000.0
KW_PER_PERSON = 2.0
KW_PER_M2 = 0.03
EXISTING_EXCLUSION_M = 500.0


def join_population(block_groups: DataFrame, population: DataFrame, key: str = "GEOID") -> DataFrame:
    return block_groups.join(population.select(key, "population"), key, "left").withColumn(
        "population", F.coalesce(F.col("population"), F.lit(0)).cast("int"))


def building_area_by_geoid(pairs: DataFrame, key: str = "GEOID", area: str = "area_m2") -> DataFrame:
    return pairs.groupBy(key).agg(F.sum(area).alias("building_area_m2"))


def join_building_area(block_groups: DataFrame, areas: DataFrame, key: str = "GEOID") -> DataFrame:
    return block_groups.join(areas, key, "left").withColumn(
        "building_area_m2", F.coalesce(F.col("building_area_m2"), F.lit(0.0)))


def overlay_intersection(polygons: DataFrame, origin: DataFrame, cell_size_m: float = CELL_SIZE_M,
                         edges: str = "edges") -> DataFrame:
    """(cell ix/iy, polygon) pairs with ``overlap_m2`` > 0.

    The grid is regular, so the cells of a polygon follow from its envelope: no join.
    ``origin`` is the one-row bounds table of the grid.
    """
    corner = origin.select(F.struct("xmin", "ymin", "xmax", "ymax").alias("o")).scalar()
    box = spatial._edge_box(F.col(edges))
    p = polygons.withColumns({"_o": corner, "_box": box})

    def span(lo, hi, start, end):
        last = F.ceil((F.col(f"_o.{end}") - F.col(f"_o.{start}")) / cell_size_m).cast("int") - 1
        first = F.greatest(F.floor((F.col(f"_box.{lo}") - F.col(f"_o.{start}")) / cell_size_m).cast("int"), F.lit(0))
        final = F.least(F.floor((F.col(f"_box.{hi}") - F.col(f"_o.{start}")) / cell_size_m).cast("int"), last)
        return F.when(first <= final, F.sequence(first, final)).otherwise(F.array().cast("array<int>"))

    p = (p.withColumn("ix", F.explode(span("xmin", "xmax", "xmin", "xmax")))
         .withColumn("iy", F.explode(span("ymin", "ymax", "ymin", "ymax"))))
    x0 = F.col("_o.xmin") + F.col("ix") * cell_size_m
    y0 = F.col("_o.ymin") + F.col("iy") * cell_size_m
    overlap = G.box_overlap_area(F.col(edges), x0, y0, x0 + cell_size_m, y0 + cell_size_m)
    return p.withColumn("overlap_m2", overlap).filter("overlap_m2 > 0").drop("_o", "_box")


def areal_interpolate(polygons: DataFrame, grid: DataFrame, origin: DataFrame, values: list[str],
                      cell_size_m: float = CELL_SIZE_M, edges: str = "edges") -> DataFrame:
    """Share polygon values out to cells by overlapped fraction of the whole polygon; no overlap gives 0.

    Shares are summed per cell before the join to the grid.
    """
    keep = polygons.select(*values, edges).withColumn("_area", G.polygon_area(F.col(edges)))
    pieces = overlay_intersection(keep, origin, cell_size_m, edges)
    share = F.col("overlap_m2") / F.col("_area")
    sums = pieces.groupBy("ix", "iy").agg(*[F.sum(F.col(v) * share).alias(v) for v in values])
    return grid.join(sums, ["ix", "iy"], "left").withColumns(
        {v: F.coalesce(F.col(v), F.lit(0.0)) for v in values})


def demand_kw(population: Column, building_area_m2: Column | None, kw_per_person: float = KW_PER_PERSON,
              kw_per_m2: float = KW_PER_M2) -> Column:
    people = population * F.lit(kw_per_person)
    return people if building_area_m2 is None else people + building_area_m2 * F.lit(kw_per_m2)


def drop_empty_cells(cells: DataFrame) -> DataFrame:
    """Cells with demand, renumbered 0.. in grid order.

    Counts per grid column are accumulated over the table of columns, so no task sorts all cells.
    """
    from geoloom.operators.skew import running_totals
    kept = cells.filter("demand_kw > 0").withColumn("_order", F.col("cell_id"))
    out = running_totals(kept, "_order", {"_rank": F.lit(1)}, bucket=F.col("ix"))
    return out.withColumn("cell_id", (F.col("_rank") - 1).cast("bigint")).drop("_rank", "_order")


def build_demand_grid(block_groups: DataFrame, has_buildings: bool = True,
                      cell_size_m: float = CELL_SIZE_M) -> DataFrame:
    """Block groups (``rings, population, building_area_m2``) → non-empty demand cells."""
    polygons = block_groups.withColumn("edges", G.edges(F.col("rings")))
    bounds = total_bounds(polygons)
    grid = make_regular_grid(bounds, cell_size_m)
    values = ["population", "building_area_m2"] if has_buildings else ["population"]
    cells = areal_interpolate(polygons, grid, bounds, values, cell_size_m)
    area = F.col("building_area_m2") if has_buildings else None
    return drop_empty_cells(cells.withColumn("demand_kw", demand_kw(F.col("population"), area)))


def filter_min_demand(cells: DataFrame, min_kw: float = 200.0) -> DataFrame:
    return cells.filter(F.col("demand_kw") >= min_kw)


def filter_min_sqft(data_centers: DataFrame, min_sqft: float = 0.0) -> DataFrame:
    if min_sqft > 0 and "sqft" in data_centers.columns:
        return data_centers.filter(F.col("sqft") >= min_sqft)
    return data_centers


def uncovered_data_centers(data_centers: DataFrame, candidates: DataFrame, stations: DataFrame,
                           radius_m: float = 10000.0, min_sqft: float = 0.0) -> DataFrame:
    """Data centres with no candidate in range and not next to a station, as extra sites."""
    far = spatial.anti_join_within(filter_min_sqft(data_centers, min_sqft), candidates, radius_m)
    return spatial.anti_join_within(far, stations, EXISTING_EXCLUSION_M, inclusive=False)


def generate_candidates(cells: DataFrame, stations: DataFrame, segments: DataFrame | None,
                        data_centers: DataFrame | None, min_demand_kw: float = 200.0,
                        line_distance_m: float = 20000.0, dc_radius_m: float = 10000.0,
                        min_sqft: float = 0.0) -> DataFrame:
    """Candidate sites ``(kind, source_id, x, y, demand_kw)``.

    Sites keep their natural key (cell or data-centre id) instead of a row number;
    use ``renumber`` for the numbered form.
    """
    sites = filter_min_demand(cells, min_demand_kw)
    sites = spatial.semi_join_near_line(sites, segments, line_distance_m)
    sites = spatial.anti_join_within(sites, stations, EXISTING_EXCLUSION_M, inclusive=False)
    sites = sites.select(F.lit("cell").alias("source"), F.col("cell_id").cast("bigint").alias("source_id"),
                         "x", "y", "demand_kw")
    if data_centers is None:
        return sites
    extra = uncovered_data_centers(data_centers, sites, stations, dc_radius_m, min_sqft)
    return sites.unionByName(extra.select(
        F.lit("data_center").alias("source"), F.col("dc_id").cast("bigint").alias("source_id"),
        "x", "y", F.lit(0.0).alias("demand_kw")))
