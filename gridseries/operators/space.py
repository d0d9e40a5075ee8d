"""Nearest locations, coordinate joins and catalogue upkeep."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridseries.functions import values
from gridseries.operators.numbering import with_position
from gridseries.schema import NEIGHBOURS, RADIUS_DEGREES
from gridseries.session import spread

# A cell splits into 4 x 4 cells of the next level.
SHIFT = 2
# A scan is pruned by at most this many ranges of cells.
CELL_RANGES = 64
# Cells with up to this many locations need no split ...
CELL_TARGET = 64
# ... and at the eighth level they have shrunk to about two metres.
MAX_LEVELS = 8


def nearest(catalogue: DataFrame, lat: float, lon: float, k: int = NEIGHBOURS,
            radius: float = RADIUS_DEGREES) -> DataFrame:
    """The k nearest locations of one point: a pushed-down box, then a top-k."""
    box = catalogue.filter(
        F.col("latitude").between(lat - radius, lat + radius)
        & F.col("longitude").between(lon - radius, lon + radius))
    d = values.degree_distance(F.lit(lat), F.lit(lon), F.col("latitude"), F.col("longitude"))
    return box.withColumn("d", d).filter(F.col("d") < radius).orderBy("d", "loc_id").limit(k)


def curve_code(row: int, column: int) -> int:
    """The number that `values.curve_cell` gives the square."""
    return sum((row >> i & 1) << 2 * i + 1 | (column >> i & 1) << 2 * i for i in range(9))


def cells_around(squares: list[tuple[int, int]], radius: float = RADIUS_DEGREES, most: int = CELL_RANGES) -> list[tuple[int, int]]:
    """Ranges of cells on the curve that hold every location within the radius of any place in the squares.

    There are 64 800 squares in all. Ranges with the smallest gaps between them are joined until at most `most` are left.
    """
    reach = math.ceil(radius)
    rows, columns = range(-reach, reach + 1), range(-reach, reach + 1)
    codes = sorted({curve_code(min(179, max(0, r + dr)), min(359, max(0, c + dc))) for r, c in squares for dr in rows for dc in columns})
    gaps = sorted((b - a for a, b in zip(codes, codes[1:])), reverse=True)
    least = max(2, gaps[most - 1] + 1 if len(gaps) >= most else 2)
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and code - ranges[-1][1] < least:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return [(low, high) for low, high in ranges]


def _points(catalogue: DataFrame, k: int) -> DataFrame:
    """Locations that can be neighbours: of those at one and the same coordinate only the k lowest ids."""
    points = catalogue.select("source", "loc_id", F.col("latitude").alias("plat"), F.col("longitude").alias("plon"))
    points = points.filter(values.is_finite(F.col("plat")) & values.is_finite(F.col("plon")))
    same = Window.partitionBy("source", "plat", "plon").orderBy("loc_id")
    return points.withColumn("_copy", F.row_number().over(same)).filter(F.col("_copy") <= k).drop("_copy")


def _at_levels(points: DataFrame, levels: int, radius: float) -> DataFrame:
    """Each point once for every level from 0, with its cell there; a cell splits into 4 x 4 of the next level."""
    finest = radius * (1 + 1e-9) / 4 ** levels
    rows = points.withColumns({"_y": F.floor(F.col("plat") / finest), "_x": F.floor(F.col("plon") / finest), "level": F.explode(F.sequence(F.lit(0), F.lit(levels)))})
    up = (F.lit(levels) - F.col("level")) * SHIFT
    return rows.withColumns({"_up": up}).withColumns({"cy": F.expr("shiftright(_y, _up)"), "cx": F.expr("shiftright(_x, _up)")}).drop("_y", "_x", "_up")


def cell_tree(points: DataFrame, levels: int, radius: float = RADIUS_DEGREES, target: int = CELL_TARGET) -> DataFrame:
    """Occupied cells with their number of points `n` and bounding box; a cell of more than `target` points has its children too.

    `split` marks those. Cells of the last level are never split.
    """
    cells = _at_levels(points, levels, radius).groupBy("source", "level", "cy", "cx").agg(
        F.count("*").alias("n"), F.min("plat").alias("south"), F.max("plat").alias("north"), F.min("plon").alias("west"), F.max("plon").alias("east"))
    cells = cells.withColumn("split", (F.col("n") > target) & (F.col("level") < levels))
    if not levels:
        return cells
    # a child has no more points than its parent, so all above a split cell are split
    parents = cells.filter("split").select("source", (F.col("level") + 1).alias("level"), F.col("cy").alias("py"), F.col("cx").alias("px"))
    below = cells.withColumns({"py": F.shiftright("cy", SHIFT), "px": F.shiftright("cx", SHIFT)})
    below = below.join(parents, ["source", "level", "py", "px"], "left_semi").drop("py", "px")
    return cells.filter("level = 0").unionByName(below)


def levels_needed(catalogue: DataFrame, radius: float = RADIUS_DEGREES, target: int = CELL_TARGET) -> int:
    """How often the most crowded cell has to be split until no cell holds more than `target` distinct places.

    One small job over the distinct coordinates of the catalogue; one row per level comes back.
    """
    points = catalogue.select("source", F.col("latitude").alias("plat"), F.col("longitude").alias("plon"))
    points = points.filter(values.is_finite(F.col("plat")) & values.is_finite(F.col("plon"))).distinct()
    counts = _at_levels(points, MAX_LEVELS, radius).groupBy("source", "level", "cy", "cx").count()
    fullest = {r["level"]: r["n"] for r in counts.groupBy("level").agg(F.max("count").alias("n")).collect()}
    return next((level for level in range(MAX_LEVELS) if fullest.get(level, 0) <= target), MAX_LEVELS)


def _descend(candidates: DataFrame, children: DataFrame, radius: float) -> DataFrame:
    """Replace each request's split cells by their children, and keep only the cells that can matter.

    The k nearest locations lie no farther than the farthest corner of the nearest cells that together hold
    k locations; cells beyond that are dropped. Cells that are not split stay as they are.
    """
    # a null key meets nothing, so cells without children pass through the join
    key = {"jy": F.when(F.col("split"), F.col("cy")), "jx": F.when(F.col("split"), F.col("cx"))}
    cell = ["level", "cy", "cx", "n", "south", "north", "west", "east", "split"]
    own = children.select("source", F.shiftright("cy", SHIFT).alias("jy"), F.shiftright("cx", SHIFT).alias("jx"), *[F.col(c).alias(f"_{c}") for c in cell])
    plain = [c for c in candidates.columns if c not in cell]
    joined = candidates.withColumns(key).join(own, ["source", "jy", "jx"], "left")
    return _pruned(joined.select(*plain, *[F.coalesce(f"_{c}", c).alias(c) for c in cell]), radius)


def _pruned(candidates: DataFrame, radius: float) -> DataFrame:
    def gap(x: Column, low: str, high: str) -> Column:
        return F.greatest(F.col(low) - x, x - F.col(high), F.lit(0.0))

    def reach(x: Column, low: str, high: str) -> Column:
        return F.greatest(F.abs(x - F.col(low)), F.abs(x - F.col(high)))

    def norm(dy: Column, dx: Column) -> Column:
        return F.sqrt(dy * dy + dx * dx)

    lat, lon = F.col("lat"), F.col("lon")
    near = norm(gap(lat, "south", "north"), gap(lon, "west", "east"))
    far = norm(reach(lat, "south", "north"), reach(lon, "west", "east"))
    within = candidates.withColumns({"_near": near, "_far": far}).filter(F.col("_near") < radius)
    whole = Window.partitionBy("req_id")
    inwards = whole.orderBy("_far", "level", "cy", "cx").rowsBetween(Window.unboundedPreceding, 0)
    enough = F.sum("n").over(inwards) >= F.col("k")
    bound = F.min(F.when(F.col("_enough"), F.col("_far"))).over(whole)
    kept = within.withColumn("_enough", enough).withColumn("_bound", bound)
    return kept.filter(F.col("_bound").isNull() | (F.col("_near") <= F.col("_bound"))).drop("_near", "_far", "_enough", "_bound")


def knn(requests: DataFrame, catalogue: DataFrame, k: int = NEIGHBOURS, radius: float = RADIUS_DEGREES,
        levels: int | None = None, target: int = CELL_TARGET) -> DataFrame:
    """The k nearest locations of every request, strictly within `radius`, nearest first.

    `requests` has (req_id, source, lat, lon) and unique ids; a column `k` up to the argument may lower it per
    row. Neighbours lie in the 3 x 3 block of radius-sized cells around a request, so this is an equi-join
    on cells. A cell of more than `target` locations is split, and its parts again, so cells are deep only where the
    catalogue is dense. Requests descend through the split cells and keep only those that can hold a neighbour; at
    last each meets the locations of its leaves, none of them crowded. `levels` bounds the depth; by default it is what
    the catalogue needs, which a small job finds. The result does not depend on either.
    """
    levels = levels_needed(catalogue, radius, target) if levels is None else levels
    points = _points(catalogue, k)
    tree = cell_tree(points, levels, radius, target)
    home = radius * (1 + 1e-9) / 4 ** levels
    kept = [c for c in requests.columns if c != "k"]
    wanted = f"least(k, {k})" if "k" in requests.columns else f"{k}"
    asked = requests.filter(values.is_finite(F.col("lat")) & values.is_finite(F.col("lon")))
    # Each request fans out into many candidates: spread the requests first, by the key they
    # are ranked by, and the candidates need no shuffle where the catalogue is broadcast.
    homes = spread(asked, "req_id").selectExpr(
        *kept, f"{wanted} as k", f"shiftright(floor(lat / {home!r}D), {SHIFT * levels}) as home_y",
        f"shiftright(floor(lon / {home!r}D), {SHIFT * levels}) as home_x")
    candidates = (homes.selectExpr("*", "explode(array(-1, 0, 1)) as dy")
                  .selectExpr("*", "explode(array(-1, 0, 1)) as dx")
                  .selectExpr(*kept, "k", "0 as level", "home_y + dy as cy", "home_x + dx as cx"))
    if levels:
        candidates = _pruned(candidates.join(tree.filter("level = 0").drop("level"), ["source", "cy", "cx"]), radius)
        for level in range(1, levels + 1):
            candidates = _descend(candidates, tree.filter(F.col("level") == level), radius)
        leaves = tree.filter("not split").select("source", "level", "cy", "cx")
        points = _at_levels(points, levels, radius).join(leaves, ["source", "level", "cy", "cx"])
    else:
        points = _at_levels(points, 0, radius)

    d = values.degree_distance(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon"))
    pairs = candidates.select(*kept, "k", "level", "cy", "cx").join(points, ["source", "level", "cy", "cx"])
    pairs = pairs.withColumn("d", d).filter(F.col("d") < radius)
    order = Window.partitionBy("req_id").orderBy("d", "loc_id")
    # the constant limit lets the ranking drop rows before they are shuffled
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.filter(F.col("rank") <= F.col("k")).select(*kept, "loc_id", "d", "rank")


def idw_weights(neighbours: DataFrame) -> DataFrame:
    """Inverse-distance weights that sum to 1 per request.

    A request on top of a location takes that location alone.
    """
    whole = Window.partitionBy("req_id")
    out = neighbours.withColumn("_least", F.min("d").over(whole))
    out = out.filter((F.col("_least") > 0) | (F.col("rank") == 1))
    inverse = F.when(F.col("_least") == 0, F.lit(1.0)).otherwise(F.try_divide(F.lit(1.0), F.col("d")))
    out = out.withColumn("_inv", inverse)
    return (out.withColumn("weight", F.col("_inv") / F.sum("_inv").over(whole))
            .drop("_least", "_inv"))


def _keyed(catalogue: DataFrame) -> DataFrame:
    return catalogue.select(
        "source", "loc_id", values.milli_degrees(F.col("longitude")).alias("lon_k"),
        values.milli_degrees(F.col("latitude")).alias("lat_k"))


def locate_cells(grid: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Give grid cells their location id; cells outside the catalogue drop out.

    Catalogues read from files are broadcast by Spark when they are small. Station coordinates
    are not unique at this precision; use `locate_stations` for them.
    """
    keyed = grid.withColumns({
        "lon_k": values.milli_degrees(F.col("longitude")),
        "lat_k": values.milli_degrees(F.col("latitude"))})
    return (keyed.join(_keyed(catalogue), ["source", "lon_k", "lat_k"])
            .drop("lon_k", "lat_k", "longitude", "latitude"))


def locate_stations(obs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Give station rows their location id by exact coordinates."""
    ids = catalogue.select("latitude", "longitude", "loc_id")
    return obs.join(ids, ["latitude", "longitude"]).drop("latitude", "longitude")


def distinct_coordinates(*tables: DataFrame) -> DataFrame:
    seen = tables[0].select("latitude", "longitude").distinct()
    for table in tables[1:]:
        seen = seen.unionByName(table.select("latitude", "longitude").distinct())
    return seen.distinct()


def extend_catalogue(old: DataFrame, seen: DataFrame) -> DataFrame:
    """Old locations keep their ids; new coordinates get the next ids in coordinate order."""
    old = old.select("loc_id", "latitude", "longitude")
    new = (seen.select("latitude", "longitude").distinct()
           .join(old, ["latitude", "longitude"], "left_anti"))
    n_old = old.count()
    numbered = with_position(new, ["latitude", "longitude"])
    added = numbered.select(
        (F.col("position") + n_old).cast("int").alias("loc_id"), "latitude", "longitude")
    return old.select(F.col("loc_id").cast("int"), "latitude", "longitude").unionByName(added)


def by_id(catalogue: DataFrame) -> DataFrame:
    """Sorted for display or export; locations without an id come last."""
    return catalogue.orderBy(F.col("loc_id").asc_nulls_last())


def check_dense_ids(catalogue: DataFrame) -> DataFrame:
    """Ids that differ from their position in id order; empty for a sound catalogue.

    Null ids come last and are always reported, one row for each, without a position.
    Positions are running counts over the distinct ids, first per block of 65 536 ids, then
    over the blocks (at most 65 536 of them), so no task sees the whole catalogue.
    """
    nulls = catalogue.filter(F.col("loc_id").isNull()).select("loc_id", F.lit(None).cast("bigint").alias("position"))
    counts = catalogue.filter(F.col("loc_id").isNotNull()).groupBy("loc_id").agg(F.count("*").alias("n"))
    counts = counts.withColumn("_block", F.shiftright("loc_id", 16))
    blocks = counts.groupBy("_block").agg(F.sum("n").alias("_n"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_block").orderBy("loc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (counts.withColumn("_seen", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(F.broadcast(blocks), "_block")
              .withColumn("_first", F.col("_before") + F.col("_seen")))
    off = placed.filter((F.col("_first") != F.col("loc_id")) | (F.col("n") > 1))
    positions = F.sequence(F.col("_first"), F.col("_first") + F.col("n") - 1)
    return (off.select("loc_id", F.explode(positions).alias("position"))
            .filter(F.col("loc_id") != F.col("position")).unionByName(nulls))
