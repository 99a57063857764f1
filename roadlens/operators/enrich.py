"""Lookups and enrichment joins.

Dimension tables derived from data (vehicles, road nodes) are joined with
plain equi-joins: AQE turns them into broadcast joins at runtime only when
their measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and keeps a shuffle join otherwise. Only tables whose size is fixed by
constants (fault codes, city boxes) carry an explicit ``broadcast`` hint.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from roadlens import schemas as S
from roadlens.functions.signals import posted_limit
from roadlens.session import checkpoint_root

NODE_SPACING_DEG = 0.01


def enrich_vehicle(df: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Add vehicle attributes (left join on vehicle_id)."""
    return df.join(vehicles, "vehicle_id", "left")


def dtc_catalog(spark: SparkSession) -> DataFrame:
    """Fault-code catalog as a DataFrame (size fixed by constants)."""
    schema = T.StructType(
        [
            T.StructField("code", T.StringType(), False),
            T.StructField("description", T.StringType(), False),
            T.StructField("severity", T.StringType(), False),
            T.StructField("engine_types", T.ArrayType(T.StringType()), False),
        ]
    )
    return spark.createDataFrame([(c, d, s, list(e)) for c, d, s, e in S.DTC_CATALOG], schema)


def enrich_dtc(ev: DataFrame, catalog: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Decode ``"CODE text"`` details into description and severity, and
    flag whether the code is plausible for the vehicle's engine type."""
    d = ev.where(F.col("detail").isNotNull()).withColumn("code", F.split(F.col("detail"), " ", 2)[0])
    d = d.join(F.broadcast(catalog), "code", "left").join(vehicles.select("vehicle_id", "engine_type"), "vehicle_id", "left")
    return d.select(
        "event_id",
        "vehicle_id",
        "event_time",
        "code",
        "description",
        "severity",
        "engine_type",
        F.coalesce(F.array_contains("engine_types", F.col("engine_type")), F.lit(False)).alias("is_plausible"),
    )


def city_boxes(spark: SparkSession) -> DataFrame:
    rows = [(c, *b) for c, b in S.CITY_BOXES.items()]
    return spark.createDataFrame(rows, "city string, lat_min double, lat_max double, lon_min double, lon_max double")


def city_of(lat: str | Column = "lat", lon: str | Column = "lon") -> Column:
    """City whose bounding box contains the point (null outside all boxes)."""
    la = F.col(lat) if isinstance(lat, str) else lat
    lo = F.col(lon) if isinstance(lon, str) else lon
    expr = None
    for city, (a, b, c, d) in S.CITY_BOXES.items():
        cond = la.between(a, b) & lo.between(c, d)
        expr = (F.when if expr is None else expr.when)(cond, F.lit(city))
    return expr


def geofence_violations(t: DataFrame, vehicles: DataFrame, boxes: DataFrame) -> DataFrame:
    """Readings outside the vehicle's home-city box; a vehicle without a
    known home has no box that a reading could lie in."""
    j = t.join(vehicles.select("vehicle_id", "home_city"), "vehicle_id", "left").join(
        F.broadcast(boxes), F.col("home_city") == F.col("city"), "left"
    )
    inside = F.col("lat").between(F.col("lat_min"), F.col("lat_max")) & F.col("lon").between(F.col("lon_min"), F.col("lon_max"))
    return j.where(~F.coalesce(inside, F.lit(False))).select("vehicle_id", "event_time", "lat", "lon", "home_city")


def road_nodes(spark: SparkSession, spacing_deg: float = NODE_SPACING_DEG) -> DataFrame:
    """Road-node lattice per city box: node (i, j) at
    ``(lat_min + i*spacing, lon_min + j*spacing)``.

    Road class and per-node override follow a fixed rule: every 10th row is
    toll, every 4th row or column arterial, (i + j) % 3 == 0 residential,
    otherwise local; nodes with i and j both multiples of 6 carry a 30 km/h
    override. Size depends only on the boxes and the spacing.
    """
    parts = []
    for city, (a, b, c, d) in S.CITY_BOXES.items():
        ni = int(round((b - a) / spacing_deg)) + 1
        nj = int(round((d - c) / spacing_deg)) + 1
        g = spark.range(ni * nj).select(
            F.lit(city).alias("city"),
            (F.col("id") / F.lit(nj)).cast("long").alias("i"),
            (F.col("id") % F.lit(nj)).alias("j"),
        )
        parts.append(g)
    nodes = parts[0]
    for p in parts[1:]:
        nodes = nodes.unionByName(p)
    i, j = F.col("i"), F.col("j")
    road_class = (
        F.when(i % 10 == 0, F.lit("toll"))
        .when((i % 4 == 0) | (j % 4 == 0), F.lit("arterial"))
        .when((i + j) % 3 == 0, F.lit("residential"))
        .otherwise(F.lit("local"))
    )
    override = F.when((i % 6 == 0) & (j % 6 == 0), F.lit(30))
    return nodes.select("city", "i", "j", road_class.alias("road_class"), override.cast("int").alias("speed_limit_kmh"))


def _lattice_index(v: Column, origin: float, spacing: float) -> Column:
    return F.floor((v - F.lit(origin)) / F.lit(spacing) + F.lit(0.5)).cast("long")


def assign_limit(t: DataFrame, nodes: DataFrame, spacing_deg: float = NODE_SPACING_DEG) -> DataFrame:
    """J8 + H15: posted limit of the nearest lattice node of the reading's city.

    The nearest node is found arithmetically (rounding to the lattice), so the
    join is an equi-join on ``(city, i, j)``; no pairwise distance search.
    """
    city = city_of()
    ii, jj = None, None
    for c, (a, _b, cc, _d) in S.CITY_BOXES.items():
        ii = (F.when if ii is None else ii.when)(city == c, _lattice_index(F.col("lat"), a, spacing_deg))
        jj = (F.when if jj is None else jj.when)(city == c, _lattice_index(F.col("lon"), cc, spacing_deg))
    d = t.withColumn("city", city).withColumn("i", ii).withColumn("j", jj)
    d = d.join(nodes, ["city", "i", "j"], "left")
    return d.withColumn("speed_limit_kmh", posted_limit("road_class", "speed_limit_kmh")).drop("i", "j")


CELL_DEG = 0.01


def _lon_scale(city: str) -> float:
    a, b, _c, _d = S.CITY_BOXES[city]
    return math.cos(math.radians((a + b) / 2.0))


def _by_city(value) -> Column:
    expr = None
    for c in S.CITY_BOXES:
        expr = (F.when if expr is None else expr.when)(F.col("city") == c, F.lit(value(c)))
    return expr


def road_segments(nodes: DataFrame) -> DataFrame:
    """The segments of the nodes' polylines: each node of a route and city with the
    next by ``seq``; class and limit are those of the node it starts at. A
    route's last node begins none, a route of one node is that point."""
    w = Window.partitionBy("city", "route_id").orderBy("seq")
    n = nodes.withColumn("_lat1", F.lead("lat").over(w)).withColumn("_lon1", F.lead("lon").over(w)).withColumn("_first", F.row_number().over(w) == 1)
    n = n.where(F.col("_lat1").isNotNull() | F.col("_first"))
    return n.select(
        "route_id", "city", "seq", F.col("lat").alias("lat0"), F.col("lon").alias("lon0"),
        F.coalesce("_lat1", "lat").alias("lat1"), F.coalesce("_lon1", "lon").alias("lon1"), "road_class", "speed_limit_kmh",
    )


def _distance2(lat, lon, s, k: Column) -> Column:
    """Squared distance, in degrees of latitude, of a point to the segment
    ``s``: to its projection on it, or to the nearer end."""
    vy, vx = s("lat1") - s("lat0"), (s("lon1") - s("lon0")) * k
    wy, wx = lat - s("lat0"), (lon - s("lon0")) * k
    size = vy * vy + vx * vx
    at = F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (wy * vy + wx * vx) / size))).otherwise(F.lit(0.0))
    dy, dx = wy - at * vy, wx - at * vx
    return dy * dy + dx * dx


def _origin(axis: int) -> Column:
    return _by_city(lambda c: S.CITY_BOXES[c][axis])


def _cells_of_segments(segments: DataFrame, cell_deg: float) -> DataFrame:
    """Grid cells that hold a part of a segment: it is cut into pieces no
    longer than a cell, each of which lies in at most four."""
    y0, y1 = (((F.col(c) - _origin(0)) / cell_deg) for c in ("lat0", "lat1"))
    x0, x1 = (((F.col(c) - _origin(2)) / cell_deg) for c in ("lon0", "lon1"))
    d = segments.select("*", y0.alias("_y0"), y1.alias("_y1"), x0.alias("_x0"), x1.alias("_x1"))
    n = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(F.col("_y1") - F.col("_y0")), F.abs(F.col("_x1") - F.col("_x0"))))).cast("int")
    d = d.withColumn("_n", n).withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))

    def span(a: str, b: str) -> Column:
        lo = F.col(a) + (F.col(b) - F.col(a)) * F.col("_p") / F.col("_n")
        hi = F.col(a) + (F.col(b) - F.col(a)) * (F.col("_p") + 1) / F.col("_n")
        # A hair more than the piece, as its ends are rounded.
        return F.sequence(F.floor(F.least(lo, hi) - 1e-9).cast("long"), F.floor(F.greatest(lo, hi) + 1e-9).cast("long"))

    d = d.withColumn("_i", F.explode(span("_y0", "_y1"))).withColumn("_j", F.explode(span("_x0", "_x1")))
    return d.select("city", "_i", "_j", "segment").distinct()


def _near_segments(cells: DataFrame, segments: DataFrame, cell_deg: float) -> DataFrame:
    """For each of ``cells`` (city, _i, _j) the segments that can be nearest
    to any of its points. Rounds of coarser grids: a cell looks at the 3 x 3
    blocks around it in an equi-join, and is done once a segment so near was
    found that none outside these blocks can be nearer; at the latest when
    the blocks hold all there is."""
    scratch = f"{checkpoint_root(cells.sparkSession)}/roadlens-segments/{uuid.uuid4().hex}"
    spark = cells.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    k = _by_city(_lon_scale)
    index = keep(_cells_of_segments(segments, cell_deg), "index")
    # Cells of cities without segments have no answer.
    waiting = keep(cells.join(index.select("city").distinct(), "city", "left_semi"), "cells0")
    ends = waiting.select("_i", "_j").unionByName(index.select("_i", "_j")).agg(F.min("_i"), F.max("_i"), F.min("_j"), F.max("_j")).first()
    span = max(ends[1] - ends[0], ends[3] - ends[2]) + 1 if ends[0] is not None else 0
    found, level = [], 1
    while True:
        last = 2**level >= span
        shift = lambda c: F.floor(F.col(c) / 2**level).cast("long")  # noqa: B023, E731
        blocks = index.select("city", shift("_i").alias("_bi"), shift("_j").alias("_bj"), "segment").distinct()
        around = waiting.select("*", F.explode(F.array(*[F.lit(x) for x in (-1, 0, 1)])).alias("_di"))
        around = around.select("*", F.explode(F.array(*[F.lit(x) for x in (-1, 0, 1)])).alias("_dj"))
        around = around.select("city", "_i", "_j", (shift("_i") + F.col("_di")).alias("_bi"), (shift("_j") + F.col("_dj")).alias("_bj"))
        pairs = around.join(blocks, ["city", "_bi", "_bj"]).select("city", "_i", "_j", "segment").distinct()
        lat, lon = _origin(0) + (F.col("_i") + 0.5) * cell_deg, _origin(2) + (F.col("_j") + 0.5) * cell_deg
        pairs = pairs.withColumn("_d", F.sqrt(_distance2(lat, lon, lambda f: F.col("segment")[f], k)))
        # From its middle to a corner; a segment may be so much nearer or farther to other points of the cell.
        half = F.sqrt(F.lit(1.0) + k * k) * (cell_deg / 2)
        least = pairs.groupBy("city", "_i", "_j").agg(F.min("_d").alias("_least"))
        pairs = pairs.join(least, ["city", "_i", "_j"]).where(F.col("_d") <= F.col("_least") + 2 * half + 1e-12)
        safe = F.lit(True) if last else F.col("_least") + 2 * half < cell_deg * 2**level * F.least(F.lit(1.0), k) * (1 - 1e-9)
        done = keep(pairs.where(safe).select("city", "_i", "_j", "segment"), f"found{level}")
        found.append(done)
        if last:
            break
        rest = waiting.join(done.select("city", "_i", "_j").distinct(), ["city", "_i", "_j"], "left_anti")
        waiting = keep(rest, f"cells{level}")
        if waiting.isEmpty():
            break
        level += 1
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def assign_limit_segments(t: DataFrame, segments: DataFrame, cell_deg: float = CELL_DEG) -> DataFrame:
    """J8 + H15 on road segments ``route_id, city, seq, lat0, lon0, lat1, lon1,
    road_class, speed_limit_kmh``: posted limit of the segment nearest to the
    reading among those of its city, by the point's projection on each (ties:
    smaller route_id, then seq). Near is by latitude and longitude with the
    city's longitude scale.

    Only grid cells that hold a reading are looked up, each once; a cell's
    distinct positions, some thousands at a time, then meet its list, which
    holds the segments within a cell's diagonal of the nearest, and halve it
    with the area they cover. Readings outside the cities, or of one without
    segments, have no limit."""
    keys = ["city", "_i", "_j"]
    d = t.withColumn("city", city_of())
    fields = ("route_id", "seq", "road_class", "speed_limit_kmh")
    s = segments.select("city", "lat0", "lon0", "lat1", "lon1", F.struct(*fields, "lat0", "lon0", "lat1", "lon1").alias("segment"))
    i, j = ((F.floor((F.col(c) - _origin(o)) / cell_deg).cast("long").alias(n) for c, o, n in (("lat", 0, "_i"), ("lon", 2, "_j"))))
    at = d.select("city", "lat", "lon").distinct().select("city", "lat", "lon", i, j).where(F.col("_i").isNotNull() & F.col("_j").isNotNull())
    cells = at.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("_n"))
    near = _near_segments(cells.select(*keys), s, cell_deg)
    group = [*keys, "_chunk"]
    chunk = F.pmod(F.xxhash64("lat", "lon"), F.col("_n")).cast("int").alias("_chunk")
    places = at.join(cells, keys).select(*keys, chunk, "lat", "lon", _by_city(_lon_scale).alias("_k"))
    near = near.join(cells, keys).select(*keys, F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_chunk"), "segment.*")
    out = T.StructType([T.StructField(f"_{c}", d.schema[c].dataType) for c in ("city", "lat", "lon")] + [T.StructField(f"_{c}", segments.schema[c].dataType) for c in fields])
    best = places.groupBy(*group).cogroup(near.groupBy(*group)).applyInArrow(_nearest_of(to_arrow_schema(out), fields), out)

    same = [F.col(c) == F.col(f"_{c}") for c in ("city", "lat", "lon")]
    r = d.join(best, same[0] & same[1] & same[2], "left").withColumn("route_id", F.col("_route_id")).withColumn("segment_seq", F.col("_seq"))
    r = r.withColumn("road_class", F.col("_road_class")).withColumn("speed_limit_kmh", posted_limit("road_class", "_speed_limit_kmh"))
    return r.drop(*out.names)


CHUNK = 8192  # positions of a cell that are looked up at once
_PAIRS = 1 << 16  # distances computed at once


def _distances2(lat: np.ndarray, lon: np.ndarray, s: np.ndarray, k: float) -> np.ndarray:
    """:func:`_distance2` of points to segments (rows lat0, lon0, lat1, lon1)."""
    vy, vx = s[2] - s[0], (s[3] - s[1]) * k
    wy, wx = lat[:, None] - s[0], (lon[:, None] - s[1]) * k
    size = vy * vy + vx * vx
    along = np.minimum(1.0, np.maximum(0.0, (wy * vy + wx * vx) / np.where(size > 0, size, 1.0)))
    along = np.where(size > 0, along, 0.0)
    dy, dx = wy - along * vy, wx - along * vx
    return dy * dy + dx * dx


def _nearest(lat: np.ndarray, lon: np.ndarray, s: np.ndarray, k: float) -> np.ndarray:
    """For each point the first of the segments nearest to it. The points'
    area is halved until few segments can be nearest to any point of it."""
    found = np.empty(len(lat), np.int64)
    todo = [(np.arange(len(lat)), np.arange(s.shape[1]))]
    while todo:
        p, q = todo.pop()
        y, x = lat[p], lon[p]
        if len(p) * len(q) <= _PAIRS or len(p) == 1:
            found[p] = q[np.argmin(_distances2(y, x, s[:, q], k), axis=1)]
            continue
        y0, y1, x0, x1 = y.min(), y.max(), x.min(), x.max()
        # From its middle to a corner; a segment may be so much nearer or farther to other points of the area.
        far = np.hypot(y1 - y0, (x1 - x0) * k) / 2
        dist = np.sqrt(_distances2(np.array([(y0 + y1) / 2]), np.array([(x0 + x1) / 2]), s[:, q], k)[0])
        q = q[dist <= dist.min() + 2 * far + 1e-12]
        if len(p) * len(q) <= _PAIRS:
            todo.append((p, q))
            continue
        by = y if y1 - y0 >= (x1 - x0) * k else x
        order = np.argsort(by, kind="stable")
        todo += [(p[order[: len(p) // 2]], q), (p[order[len(p) // 2 :]], q)]
    return found


def _nearest_of(schema: pa.Schema, fields: tuple[str, ...]):
    """Cogroup function: positions of a cell and the segments that can be
    nearest there -> each position with its segment's ``fields``."""

    def run(places: pa.Table, near: pa.Table) -> pa.Table:
        if not places.num_rows or not near.num_rows:
            return schema.empty_table()
        # Of segments equally near the first by these.
        near = near.take(pc.sort_indices(near, sort_keys=[(c, "ascending") for c in fields], null_placement="at_start"))
        s = np.stack([near[c].to_numpy().astype(np.float64) for c in ("lat0", "lon0", "lat1", "lon1")])
        lat, lon = (places[c].to_numpy().astype(np.float64) for c in ("lat", "lon"))
        at = pa.array(_nearest(lat, lon, s, places["_k"][0].as_py()))
        cols = [places[c] for c in ("city", "lat", "lon")] + [near[c].take(at) for c in fields]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def assign_limit_nodes(t: DataFrame, nodes: DataFrame, cell_deg: float = CELL_DEG) -> DataFrame:
    """J8 + H15 on a given node table ``route_id, city, seq, lat, lon,
    road_class, speed_limit_kmh``: as :func:`assign_limit_segments`, every
    node a segment of no length."""
    points = nodes.select(
        "route_id", "city", "seq", F.col("lat").alias("lat0"), F.col("lon").alias("lon0"),
        F.col("lat").alias("lat1"), F.col("lon").alias("lon1"), "road_class", "speed_limit_kmh",
    )
    return assign_limit_segments(t, points, cell_deg).withColumnRenamed("segment_seq", "node_seq")
