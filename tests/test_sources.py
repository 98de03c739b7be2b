import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.operators import quality
from geoloom.sources import ranges, readers, sinks


def geojson(path, *geometries):
    features = [{"type": "Feature", "properties": {"GEOID": str(i), "STATEFP": "04", "COUNTYFP": "013"}, "geometry": g} for i, g in enumerate(geometries)]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    return str(path)


SQUARE = [[0, 0], [0, 10], [10, 10], [10, 0], [0, 0]]
HOLE = [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]


def test_polygons_with_holes_and_parts(spark, tmp_path):
    far = [[[x + 20, y] for x, y in SQUARE]]
    path = geojson(tmp_path / "bg.geojson", {"type": "Polygon", "coordinates": [SQUARE, HOLE]},
                   {"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE], far]}, {"type": "Point", "coordinates": [1, 1]})
    out = readers.read_block_groups(spark, path, "04", "013").withColumn("a", G.polygon_area(G.edges(F.col("rings"))))
    assert {r.GEOID: r.a for r in out.collect()} == {"0": 96.0, "1": 196.0}


def test_lines_of_both_kinds_and_absent_files(spark, tmp_path):
    path = geojson(tmp_path / "lines.geojson", {"type": "LineString", "coordinates": [[0, 0], [3, 4], [3, 5]]},
                   {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 0]], [[5, 5], [6, 5]]]})
    lines = readers.read_transmission_lines(spark, path, str(tmp_path / "minor.geojson"))
    assert readers.line_segments(lines.select("path")).count() == 4
    assert readers.read_transmission_lines(spark, str(tmp_path / "none.geojson")) is None
    assert readers.read_building_footprints(spark, str(tmp_path / "b.parquet"), str(tmp_path / "b.geojson")) is None


def test_census_file(spark, tmp_path):
    rows = [["P1_001N", "state", "county", "tract", "block group"], ["12", "04", "013", "000101", "1"], ["0", "04", "013", "000101", "2"]]
    (tmp_path / "census.json").write_text(json.dumps(rows))
    got = readers.read_census_population(spark, str(tmp_path / "census.json")).collect()
    assert [(r.GEOID, r.population) for r in got] == [("040130001011", 12), ("040130001012", 0)]


def test_empty_detections_raise(spark, tmp_path):
    pd.DataFrame({"patch_id": ["a"], "label": ["negative"], "center_lon": [1.0], "center_lat": [1.0], "county_geoid": [4013]}).to_csv(tmp_path / "m.csv", index=False)
    with pytest.raises(ValueError):
        readers.read_detections(spark, str(tmp_path / "m.csv"), "04013")


def test_channel_stats_default(spark, tmp_path):
    assert readers.read_channel_stats(spark, str(tmp_path / "none.json")) == (list(readers.DEFAULT_MEAN), list(readers.DEFAULT_STD))
    (tmp_path / "s.json").write_text('{"mean": [1, 2],\n "std": [3, 4]}')
    assert readers.read_channel_stats(spark, str(tmp_path / "s.json")) == ([1.0, 2.0], [3.0, 4.0])


def test_discover_prefers_direct_metadata(spark, tmp_path):
    for name, sub in (("a", ""), ("a", "raw"), ("b", "raw")):
        folder = tmp_path / name / sub
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "metadata.csv").write_text(f"patch_id\n{name}{sub}\n")
    got = readers.discover_datasets(spark, str(tmp_path)).collect()
    assert sorted((r.dataset, r.patch_id) for r in got) == [("a", "a"), ("b", "braw")]


def test_patches_from_files(spark, tmp_path):
    (tmp_path / "p1.bin").write_bytes(bytes([1, 2, 3, 4]))
    (tmp_path / "p2.bin").write_bytes(bytes([7, 7, 7, 7]))
    out = readers.read_patches(spark, str(tmp_path / "*.bin"), lambda b: {"height": 2, "width": 2, "red": list(b)}, "height int, width int, red array<int>")
    got = {r.patch_id: (r.red, len(r.sha256)) for r in out.collect()}
    assert got == {"p1": ([1, 2, 3, 4], 64), "p2": ([7, 7, 7, 7], 64)}


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, 3.5, "train"), (2, 4.5, 5.5, "test")], "id long, center_lon double, center_lat double, split string")
    sinks.write_geojson(df, str(tmp_path / "g"))
    docs = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "g")).collect()]
    assert {d["properties"]["id"]: d["geometry"]["coordinates"] for d in docs} == {1: [2.5, 3.5], 2: [4.5, 5.5]}
    sinks.write_by_split(df, str(tmp_path / "s"))
    assert {p.name for p in (tmp_path / "s").iterdir() if p.is_dir()} == {"split=train", "split=test"}
    back = readers.geojson_features(spark, str(tmp_path / "g"), lines=True)
    assert back.count() == 2


def test_guards(spark):
    a = spark.createDataFrame([("1",), ("2",)], "county_geoid string")
    with pytest.raises(ValueError):
        quality.require_disjoint(a, a.limit(1))
    registry = spark.createDataFrame([("1", "x")], "geoid string, name string")
    with pytest.raises(ValueError):
        quality.lookup_counties(a.withColumnRenamed("county_geoid", "geoid"), registry)


def test_feature_ranges_read_every_feature_once(spark, tmp_path):
    """Ranges of every size begin in strings, in nested objects and in the middle of what marks a feature."""
    import json

    features = [{"type": "Feature", "properties": {"id": i, "note": '{"type": "Feature", } \\" {' * (i % 4), "é": "}" * (i % 3),
                                                   "inner": {"type": "Feature", "geometry": {"a": [{}, {}]}} if i % 5 == 0 else None},
                 "geometry": {"type": "Point", "coordinates": [i, -i]}} for i in range(60)]
    text = json.dumps({"type": "FeatureCollection", "name": "x", "features": features}, ensure_ascii=False).encode()
    for size in (37, 64, 501, len(text) + 5):
        found = []
        for start in range(0, len(text), size):
            found += ranges.features_between(lambda at, n: text[at:at + n], start, min(start + size, len(text)))
        assert [json.loads(f)["properties"]["id"] for f in found] == list(range(60))
    (tmp_path / "one.geojson").write_bytes(text)
    df = ranges.read_feature_ranges(spark, str(tmp_path / "one.geojson"), 1000)
    assert df.rdd.getNumPartitions() == -(-len(text) // 1000)
    assert sorted(int(r.properties["id"]) for r in df.collect()) == list(range(60))


def test_small_reads_find_features_too(monkeypatch):
    monkeypatch.setattr(ranges, "MORE_BYTES", 3)
    text = b'{"type":"FeatureCollection","features":[ {"type" : "Feature","p":{"a":"\\\\"},"q":"]}"} , {"type":"Feature"}]}'
    found = list(ranges.features_between(lambda at, n: text[at:at + n], 0, len(text)))
    assert found == [b'{"type" : "Feature","p":{"a":"\\\\"},"q":"]}"}', b'{"type":"Feature"}']


def test_one_partition_per_window(spark, tmp_path):
    data = [[r * 100 + c for c in range(10)] for r in range(7)]

    def decode(path, row, col, height, width):
        return {"v": [data[r][c] for r in range(row, row + height) for c in range(col, col + width)]}
    df = ranges.read_windows(spark, [("a", 7, 10), ("b", 3, 2)], decode, {"v": "double"}, size=4, halo=1)
    assert df.rdd.getNumPartitions() == 6 + 1
    got = {(r.path, r.row_off, r.col_off): r for r in df.collect()}
    assert set(got) == {("a", r, c) for r in (0, 3) for c in (0, 3, 7)} | {("b", 0, 0)}
    assert (got["a", 3, 7].height, got["a", 3, 7].width) == (4, 3) and got["a", 3, 7].v[0] == 307.0
    assert (got["a", 0, 3].height, got["a", 0, 3].width) == (5, 6)
