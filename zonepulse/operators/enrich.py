"""Joins that give records a zone: by exact location, by name, by point."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.functions.plan import spread
from zonepulse.functions.text import standardize_name
from zonepulse.sources.scratch import broadcast_if_small, is_small, materialize

# Length of the name pieces that candidate pairs must share before `contains` is tried.
_GRAM = 4
# Locations with more than one event in so many are joined without a shuffle.
_HEAVY_SHARE = 10_000
_EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
# Grid resolution for city zones. A power of two, so cell numbers and cell borders are exact in doubles.
CELLS_PER_DEGREE = 128


def lookup_location(events: DataFrame, locations: DataFrame, on: str) -> DataFrame:
    """Exact match on the raw location; a miss gives 0.0, 0.0 and UNKNOWN."""
    table = broadcast_if_small(locations.withColumnRenamed("raw_location", on))
    joined = events.join(table, on, "left")
    return joined.select(
        *[F.col(n) for n in events.columns],
        F.coalesce("lat", F.lit("0.0")).alias("lat"),
        F.coalesce("lon", F.lit("0.0")).alias("lon"),
        F.coalesce("location_id", F.lit("UNKNOWN")).alias("location_id"),
    )


def _pieces(text: Column, length: int = _GRAM) -> Column:
    """The distinct pieces of the given length, one per row; a shorter text has none."""
    starts = F.when(F.length(text) >= length, F.sequence(F.lit(1), F.length(text) - length + 1))
    return F.explode(F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, length))))


def _short_lengths(texts: DataFrame, column: str) -> list[int]:
    """The lengths below that of a piece that occur; three at most."""
    size = F.length(column).alias("size")
    return sorted(r[0] for r in texts.select(size).filter(F.col("size").between(1, _GRAM - 1)).distinct().collect())


def _candidates(names: DataFrame, known: DataFrame) -> DataFrame:
    """(_std, zone_name, location_id) where one text contains the other. ``names``: distinct locations (_std).

    A text that contains another has all of its pieces, so it is enough to look for one: the piece of the
    contained text that the fewest zone names have. Texts shorter than a piece are looked for whole.
    """
    pieces = materialize(known.select("zone_name", "location_id", _pieces(F.col("zone_name")).alias("piece")), "pieces")
    often = broadcast_if_small(pieces.groupBy("piece").agg(F.count_distinct("zone_name").alias("n")))
    rarest = F.min_by("piece", F.struct("n", "piece")).alias("piece")
    zone_keys = pieces.join(often, "piece").groupBy("zone_name", "location_id").agg(rarest)
    place_pieces = names.select("_std", _pieces(F.col("_std")).alias("piece"))
    found = [place_pieces.join(broadcast_if_small(zone_keys), "piece")]
    # a location with a piece that no zone has is in none
    n_pieces = F.size(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_std") - _GRAM + 1), lambda i: F.substring("_std", i, _GRAM))))
    place_keys = place_pieces.join(often, "piece").groupBy("_std").agg(rarest, F.count("*").alias("met")).filter(F.col("met") == n_pieces)
    found.append(place_keys.join(broadcast_if_small(pieces), "piece"))
    for length in _short_lengths(known, "zone_name"):
        short = broadcast_if_small(known.filter(F.length("zone_name") == length).withColumn("piece", F.col("zone_name")))
        found.append(names.select("_std", _pieces(F.col("_std"), length).alias("piece")).join(short, "piece"))
    for length in _short_lengths(names, "_std"):
        longer = broadcast_if_small(known.select("zone_name", "location_id", _pieces(F.col("zone_name"), length).alias("piece")))
        found.append(names.filter(F.length("_std") == length).withColumn("piece", F.col("_std")).join(longer, "piece"))
    pairs = reduce(DataFrame.unionByName, [f.select("_std", "zone_name", "location_id") for f in found])
    return pairs.filter(F.contains("_std", "zone_name") | F.contains("zone_name", "_std"))


def match_zone_by_name(events: DataFrame, zones: DataFrame, on: str, default: int = -1) -> DataFrame:
    """Zone whose standardised name contains, or is contained in, the standardised location.

    The longest overlap wins, then the smallest id; no match or no location gives ``default``.
    Each distinct location is matched once. Locations of very many events are few by their number, so
    their zones are broadcast whatever the size of the rest.
    """
    std = "_location"
    keyed = events.withColumn(std, standardize_name(F.col(on)))
    places = keyed.filter(F.col(std) != "").groupBy(F.col(std).alias("_std")).agg(F.count("*").alias("events"))
    places = materialize(places, "places")
    known = materialize(zones.filter(F.col("zone_name") != "").select("zone_name", "location_id"), "zones")

    overlap = F.least(F.length("_std"), F.length("zone_name"))
    best = (
        _candidates(places.select("_std"), known)
        .groupBy("_std")
        .agg(F.max(F.struct(overlap.alias("overlap"), (-F.col("location_id")).alias("low"))).alias("best"))
        .select("_std", (-F.col("best.low")).alias("location_id"))
    )
    best = materialize(best, "best")
    if is_small(best):
        found = keyed.join(F.broadcast(best), F.col(std) == F.col("_std"), "left")
    else:
        found = _matched_back(keyed, places, best, std)
    return found.select(*events.columns, F.coalesce("location_id", F.lit(default)).alias("location_id"))


def _matched_back(keyed: DataFrame, places: DataFrame, best: DataFrame, std: str) -> DataFrame:
    """``keyed`` with the zones of ``best``, when those are too many to broadcast.

    Locations with more than a ten-thousandth of all events are at most 10,000, so their zones are broadcast. Events of
    those, and events without a location, need no partner in the shuffle: they get keys of their own, which are spread
    over all tasks.
    """
    limit = places.agg(F.sum("events")).first()[0] / _HEAVY_SHARE
    heavy = best.join(places.filter(F.col("events") > limit).select("_std"), "_std").select(F.col("_std").alias("_heavy"), F.col("location_id").alias("_zone"))
    marked = keyed.join(F.broadcast(heavy), F.col(std) == F.col("_heavy"), "left")
    alone = F.col("_heavy").isNotNull() | (F.col(std) == "")
    spread_key = F.concat(F.lit("\0"), F.xxhash64(*keyed.columns).cast("string"))
    marked = marked.withColumn("_key", F.when(alone, spread_key).otherwise(F.col(std)))
    joined = marked.join(best, F.col("_key") == F.col("_std"), "left")
    return joined.withColumn("location_id", F.coalesce("_zone", "location_id"))


# -- point in polygon


def _edge(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def _turn(e: Column, x: Column, y: Column) -> Column:
    """Positive, zero or negative as the point lies left of, on, or right of the edge's line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def _crossed(e: Column, x: Column, y: Column) -> Column:
    """A ray from the point towards larger x crosses the edge."""
    upward = e["y2"] > e["y1"]
    return ((e["y1"] > y) != (e["y2"] > y)) & F.when(upward, _turn(e, x, y) > 0).otherwise(_turn(e, x, y) < 0)


def _touched(e: Column, x: Column, y: Column) -> Column:
    """The point lies on the edge."""
    return (
        (_turn(e, x, y) == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def _passes(e: Column, x: Column, y: Column, rx: Column, ry: Column) -> Column:
    """The way from (x, y) to (rx, ry) crosses the edge. An end of the edge on the line of the way counts to one side."""
    def side(px: Column, py: Column) -> Column:
        return (rx - x) * (py - y) - (px - x) * (ry - y) > 0

    return (side(e["x1"], e["y1"]) != side(e["x2"], e["y2"])) & ((_turn(e, x, y) > 0) != (_turn(e, rx, ry) > 0))


def _reaches(e: Column, x0: Column, y0: Column, step: Column | float) -> Column:
    """The edge has a point in the closed square: their extents meet, and the corners are not all on one side of it."""
    x1, y1 = x0 + step, y0 + step
    turns = [_turn(e, x, y) for x in (x0, x1) for y in (y0, y1)]
    extents = (F.least(e["x1"], e["x2"]) <= x1) & (F.greatest(e["x1"], e["x2"]) >= x0) & (
        F.least(e["y1"], e["y2"]) <= y1) & (F.greatest(e["y1"], e["y2"]) >= y0)
    return extents & (F.least(*turns) <= 0) & (F.greatest(*turns) >= 0)


# Each cell has a point of reference at these shares of its sides; odd numbers, so that no corner or edge of a map lies there.
_REF_X, _REF_Y = 0.45678912345678, 0.54321987654321
# A cell with more edges than this is cut into four, at most so many times.
EDGES_PER_CELL = 64
MAX_CUTS = 20


def _ref(step: Column | float, ix: Column, iy: Column) -> tuple[Column, Column]:
    return (ix + _REF_X) * step, (iy + _REF_Y) * step


def _base_cells(zones: DataFrame, cells_per_degree: int) -> tuple[DataFrame, DataFrame]:
    """Cells of the grid by zone, with ``odd`` (the point of reference is inside) and ``n`` edges; and their edges, one per row."""
    step = 1.0 / cells_per_degree

    def cell(c: Column) -> Column:
        return F.floor(c * cells_per_degree)

    ring = F.col("ring")
    n = F.size(ring)
    edges = zones.select(
        "location_id", "zone", "borough",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda i: _edge(
                    F.get(ring, i)["x"], F.get(ring, i)["y"],
                    F.get(ring, (i + 1) % n)["x"], F.get(ring, (i + 1) % n)["y"],
                ),
            )
        ).alias("e"),
    )
    e = F.col("e")
    edges = materialize(edges.withColumns({
        "left": F.least(e["x1"], e["x2"]), "right": F.greatest(e["x1"], e["x2"]),
        "low": F.least(e["y1"], e["y2"]), "high": F.greatest(e["y1"], e["y2"]),
    }), "edges")
    extent = edges.groupBy("location_id", "zone", "borough").agg(
        F.min("left").alias("x_min"), F.max("right").alias("x_max"),
        F.min("low").alias("y_min"), F.max("high").alias("y_max"),
    )
    grid = extent.select(
        "location_id", "zone", "borough",
        F.explode(F.sequence(cell(F.col("x_min")), cell(F.col("x_max")))).alias("ix"),
        F.sequence(cell(F.col("y_min")), cell(F.col("y_max"))).alias("iys"),
    ).withColumn("iy", F.explode("iys")).drop("iys")

    bands = edges.drop("zone", "borough").withColumn("iy", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    x0, y0 = F.col("ix") * step, F.col("iy") * step
    near = grid.join(bands, ["location_id", "iy"]).filter(F.col("right") >= x0)
    counted = near.groupBy("ix", "iy", "location_id", "zone", "borough").agg(
        F.count_if(_reaches(e, x0, y0, step)).alias("n"), (F.count_if(_crossed(e, *_ref(step, F.col("ix"), F.col("iy")))) % 2 == 1).alias("odd"))
    local = edges.select(
        "location_id", "e", F.explode(F.sequence(cell(F.col("left")), cell(F.col("right")))).alias("ix"), "low", "high",
    ).withColumn("iy", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high"))))).filter(_reaches(e, x0, y0, step))
    return counted.filter("odd OR n > 0"), local.select("ix", "iy", "location_id", "e")


def _quarters(df: DataFrame) -> DataFrame:
    """Each row four times, with the place of a quarter of its cell: jx, jy."""
    four = df.select("*", F.explode(F.expr("sequence(0, 3)")).alias("q"))
    return four.withColumns({"jx": 2 * F.col("ix") + F.expr("q % 2"), "jy": 2 * F.col("iy") + F.expr("q div 2")}).drop("q")


def _cut(cells: DataFrame, edges: DataFrame, step: float) -> tuple[DataFrame, DataFrame]:
    """The four quarters of each cell, and their edges. The way between the points of reference tells which are inside."""
    ix, iy, jx, jy, e = (F.col(c) for c in ("ix", "iy", "jx", "jy", "e"))
    parted = _quarters(edges).withColumns({
        "local": _reaches(e, jx * (step / 2), jy * (step / 2), step / 2),
        "passes": _passes(e, *_ref(step, ix, iy), *_ref(step / 2, jx, jy)),
    })
    keys = ["location_id", "jx", "jy"]
    counts = parted.groupBy(*keys).agg(F.count_if("local").alias("m"), (F.count_if("passes") % 2 == 1).alias("turned"))
    quarters = _quarters(cells).join(counts, keys, "left").select(
        jx.alias("ix"), jy.alias("iy"), "location_id", "zone", "borough",
        F.coalesce("m", F.lit(0)).cast("bigint").alias("n"), (F.col("odd") != F.coalesce("turned", F.lit(False))).alias("odd"))
    return quarters.filter("odd OR n > 0"), parted.filter("local").select(jx.alias("ix"), jy.alias("iy"), "location_id", "e")


def zone_cells(zones: DataFrame, cells_per_degree: int = CELLS_PER_DEGREE, edges_per_cell: int = EDGES_PER_CELL) -> DataFrame:
    """Quadtree over the zone polygons: per leaf cell the zones that reach into it, smallest id first.

    Input: location_id, zone, borough, ring (array of x/y structs, open or closed); several rows of one
    zone are its further rings or holes. Cells of the grid with more than ``edges_per_cell`` edges are cut
    into four until few are left (or MAX_CUTS is reached: so many edges meet in a point), so a row holds few of them however
    fine a polygon is drawn. A cell without an edge needs no test later; for the others it is known whether their point of
    reference is inside. Rows: level, ix, iy, candidates; a cell of the grid that is cut has ``levels``, where its leaves are.
    The table grows with the polygons, not with the points; it is broadcast when it is small.
    """
    cells, edges = _base_cells(zones, cells_per_degree)
    step, level, leaves, places = 1.0 / cells_per_degree, 0, [], None
    while True:
        cells, edges = materialize(cells, "cells"), materialize(edges, "cell-edges")
        full = cells.groupBy("ix", "iy").agg(F.sum("n").alias("all")).filter(F.col("all") > edges_per_cell).select("ix", "iy")
        full = materialize(full, "full")
        last = level == MAX_CUTS or full.isEmpty()
        done, kept = (cells, edges) if last else (cells.join(full, ["ix", "iy"], "left_anti"), edges.join(full, ["ix", "iy"], "left_anti"))
        lists = kept.groupBy("ix", "iy", "location_id").agg(F.collect_list("e").alias("edges"))
        candidate = F.struct("location_id", "zone", "borough", "odd", "edges")
        rows = done.join(lists, ["ix", "iy", "location_id"], "left").groupBy("ix", "iy").agg(F.sort_array(F.collect_list(candidate)).alias("candidates"))
        if places is not None:  # quarters in no zone are leaves too, so that every point below a cut cell meets one
            rows = rows.unionByName(places.join(cells, ["ix", "iy"], "left_anti").withColumn("candidates", F.array().cast(rows.schema["candidates"].dataType)))
        leaves.append(rows.withColumn("level", F.lit(level)))
        if last:
            break
        places = _quarters(full).select(F.col("jx").alias("ix"), F.col("jy").alias("iy"))
        cells, edges = _cut(cells.join(full, ["ix", "iy"], "left_semi"), edges.join(full, ["ix", "iy"], "left_semi"), step)
        step, level = step / 2, level + 1
    table = materialize(reduce(DataFrame.unionByName, leaves), "leaves")
    if level:
        size = F.pow(F.lit(2), F.col("level")).cast("bigint")
        below = table.filter("level > 0").groupBy(F.floor(F.col("ix") / size).alias("ix"), F.floor(F.col("iy") / size).alias("iy"))
        below = below.agg(F.sort_array(F.collect_set("level")).alias("levels")).withColumn("level", F.lit(0))
        table = materialize(table.unionByName(below, allowMissingColumns=True), "tree")
    else:
        table = table.withColumn("levels", F.lit(None).cast("array<int>"))
    return broadcast_if_small(table)


def assign_zone_by_point(
    points: DataFrame,
    cells: DataFrame,
    lng: str,
    lat: str,
    out: str = "location_id",
    attributes: bool = False,
    cells_per_degree: int = CELLS_PER_DEGREE,
) -> DataFrame:
    """Zone id of the polygon around each point, null when there is none; a border point is in no zone.

    A point meets at most one cell of the grid, and below a cell that is cut exactly one leaf, so the result has exactly
    the rows of ``points``.
    """
    x, y = F.col(lng), F.col(lat)
    real = ~(F.isnan(x) | F.isnan(y))

    def place(c: Column, size: Column | int) -> Column:
        return F.when(real, F.floor(c * size))

    keyed = points.withColumns({"level": F.lit(0), "ix": place(x, cells_per_degree), "iy": place(y, cells_per_degree)})
    joined = keyed.join(cells, ["level", "ix", "iy"], "left")
    if not cells.filter("level > 0").isEmpty():
        # below a cut cell: one row for each level that has leaves there, of which one meets a leaf
        size = cells_per_degree * F.pow(F.lit(2), F.coalesce("level", F.lit(0))).cast("bigint")
        each = joined.select(*points.columns, F.col("candidates").alias("at_once"), F.explode_outer("levels").alias("level"))
        each = each.withColumns({"ix": place(x, size), "iy": place(y, size)})
        joined = each.join(cells.drop("levels").filter("level > 0"), ["level", "ix", "iy"], "left")
        joined = joined.filter("level IS NULL OR candidates IS NOT NULL").withColumn("candidates", F.coalesce("candidates", "at_once"))
    step = 1.0 / (cells_per_degree * F.pow(F.lit(2), F.coalesce("level", F.lit(0))))

    def inside(z: Column) -> Column:
        edges = F.coalesce(z["edges"], F.array().cast(_EDGES))
        odd = F.aggregate(edges, z["odd"], lambda acc, e: acc != _passes(e, x, y, *_ref(step, F.col("ix"), F.col("iy"))))
        return odd & ~F.exists(edges, lambda e: _touched(e, x, y))

    hit = F.get(F.filter("candidates", inside), F.lit(0))
    extra = {f"{out}_zone": hit["zone"], f"{out}_borough": hit["borough"]} if attributes else {}
    return joined.select(*points.columns, hit["location_id"].alias(out), *[c.alias(n) for n, c in extra.items()])


def unmatched_points(rides: DataFrame, key: str = "ride_id") -> DataFrame:
    """One row per ride end without a zone: side, key, latitude, longitude."""
    ends = ("start", "end")
    rows = [[F.lit(side), F.col(f"{side}_lat"), F.col(f"{side}_lng")] for side in ends]
    lost = [F.col(f"{side}_location_id").isNull() for side in ends]
    return rides.select(key, spread(["side", "lat", "lng"], *rows, when=lost))
