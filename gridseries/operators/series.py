"""Time ranges, tiers and merging of series."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.functions.times import as_time
from gridseries.functions.values import curve_place
from gridseries.schema import CURRENT, HISTORIC, SERIES
from gridseries.session import ensure_checkpoint_dir, spread

# Requests that share one copy of the observations around them, at most.
BLOCK = 1024
# The days of observations that are taken together.
SPAN_DAYS = 32
# `_of` is struct(source, loc_id): Spark would drop a literal source from the keys, and shuffle the rows again
SERIES_PART = ["loc_id", "_of", "span"]


def time_range(df: DataFrame, start, end) -> DataFrame:
    """Inclusive range; pushed down to the scan."""
    return df.filter(F.col("time").between(as_time(start), as_time(end)))


def tier_bounds(obs: DataFrame) -> DataFrame:
    return obs.groupBy("source", "tier").agg(
        F.min("time").alias("min_time"), F.max("time").alias("max_time"), F.count("*").alias("n"))


def route_tiers(requests: DataFrame, bounds: DataFrame) -> DataFrame:
    """Which tiers a request reads, by the bounds of its source.

    A start inside history reads history, and the current tier too if the range reaches it. A
    start inside the current tier reads only that. A start between the tiers reads nothing.
    """
    def bound(column: str, tier: str) -> Column:
        return F.max(F.when(F.col("tier") == tier, F.col(column)))

    # one row per source
    per_source = bounds.groupBy("source").agg(
        bound("max_time", HISTORIC).alias("hist_max"), bound("min_time", CURRENT).alias("cur_min"))
    out = requests.join(F.broadcast(per_source), "source", "left")
    in_history = F.coalesce(F.col("start_time") <= F.col("hist_max"), F.lit(False))
    reaches = F.coalesce(F.col("end_time") >= F.col("cur_min"), F.lit(False))
    in_current = F.coalesce(F.col("start_time") >= F.col("cur_min"), F.lit(False))
    return out.select(
        *[F.col(c) for c in requests.columns],
        in_history.alias("read_historic"),
        ((in_history & reaches) | (~in_history & in_current)).alias("read_current"))


def union_priority(first: DataFrame, second: DataFrame, keys: list[str],
                   together: list[str] | None = None) -> DataFrame:
    """Union where rows of `first` win over rows of `second` with the same keys.

    Columns are picked by priority one by one: as long as they are numbers or times, the merge
    is a hash aggregate. Within one input `keys` must be unique, so few rows meet before the shuffle; it comes
    first, by those keys in `together`, and no task holds the groups of a large piece of input.
    """
    tagged = (first.withColumn("_prio", F.lit(0))
              .unionByName(second.select(first.columns).withColumn("_prio", F.lit(1))))
    rest = [c for c in first.columns if c not in keys]
    picks = [F.min_by(c, "_prio").alias(c) for c in rest]
    # the number keeps adaptive execution from merging partitions whose rows are small while they are shuffled
    n = int(first.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tagged.repartition(n, *(together or keys)).groupBy(*keys).agg(*picks).select(first.columns)


def serve_tiers(obs: DataFrame) -> DataFrame:
    """One row per series and time; history wins where the tiers overlap."""
    first = F.min("_prio")
    tagged = obs.withColumn("_prio", F.when(F.col("tier") == HISTORIC, 0).otherwise(1))
    best = tagged.groupBy(*SERIES, "time").agg(first.alias("_first"), F.min_by("value", "_prio").alias("value"))
    tier = F.when(F.col("_first") == 0, HISTORIC).otherwise(CURRENT)
    return best.select(*SERIES, "time", tier.alias("tier"), "value")


def _request_blocks(neighbours: DataFrame, size: int) -> DataFrame:
    """(block, req_id, near): each request's neighbours as an array, at most `size` requests that lie together in a block.

    Requests are sorted along a curve over the map. The first checkpoint keeps the neighbour search from running again
    to find the borders of the sorted partitions, the second one those borders from differing between two reads.
    """
    ensure_checkpoint_dir(neighbours.sparkSession)
    near = neighbours.filter(F.col("req_id").isNotNull()).groupBy("req_id").agg(
        F.min(curve_place(F.col("lat"), F.col("lon"))).alias("_place"),
        F.collect_list(F.struct("source", "loc_id", "weight")).alias("near")).checkpoint()
    order = ["_place", "req_id"]
    placed = near.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select(F.expr(f"monotonically_increasing_id() div {size}").alias("block"), "req_id", "near").checkpoint()


def _with_span(obs: DataFrame) -> DataFrame:
    span = F.floor(F.unix_date(F.to_date("time")) / SPAN_DAYS)
    return obs.withColumn("span", F.coalesce(span, F.lit(0)))


def _packed(obs: DataFrame) -> DataFrame:
    """One row per series, tier and span, with `cells` of (time, counts, total).

    `counts` has the rows of a time in its upper half and those with a value in its lower half.
    """
    rows = obs.filter(F.col("source").isNotNull()).select(
        "loc_id", F.struct("source", "loc_id").alias("_of"), "span", "tier", "var", "time", "value")
    counts = F.shiftleft(F.count("*"), 32) + F.count("value")
    per_time = spread(rows, *SERIES_PART).groupBy(*SERIES_PART, "tier", "var", "time").agg(
        counts.alias("counts"), F.sum("value").alias("total"))
    return per_time.groupBy(*SERIES_PART, "tier", "var").agg(
        F.collect_list(F.struct("time", "counts", "total")).alias("cells"))


def _by_number(name: str, kind: str) -> Column:
    """One field of `cells`, which are sorted by number, as an array with nulls at the numbers between."""
    def padded(cell: Column, i: Column) -> Column:
        last = F.coalesce(F.get("cells", i - 1)["number"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(None).cast(kind), cell["number"] - last - 1), F.array(cell[name]))

    return F.flatten(F.transform("cells", padded)).alias(name)


def interpolate(obs: DataFrame, neighbours: DataFrame, block: int = BLOCK) -> DataFrame:
    """Weighted sum over a request's neighbours, per tier, variable and time.

    A time survives if every neighbour has a row there; the value is null if one of theirs is. `neighbours`
    has (req_id, source, lat, lon, loc_id, weight), as `idw_weights` gives them.

    Requests that lie together are answered in blocks of up to `block`. The locations of a block are numbered; their
    rows are brought together once for all its requests, and each time becomes one row of values by number, which
    meets the requests in the last step. So the shuffled volume follows the observations and the requests, not their
    product. The result does not depend on `block`. Some jobs over the neighbours run at once, the rest is lazy.
    """
    blocks = _request_blocks(neighbours, block)
    most = blocks.agg(F.max(F.size("near"))).first()[0] or 0
    spots = (blocks.select("block", F.explode("near").alias("_x")).select("block", "_x.source", "_x.loc_id").distinct()
             .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("source", "loc_id"))).alias("spots")))
    numbered = spots.select("block", F.posexplode("spots").alias("number", "_x")).select(
        "block", "number", "_x.loc_id", F.col("_x").alias("_of"))

    spanned = _with_span(obs)
    # as many as the history is long
    spans = F.broadcast(spanned.select("span").distinct())
    # estimates take rows from small files for small, and a broadcast would then hold all of them in every task
    placed = _packed(spanned).hint("merge").join(numbered.crossJoin(spans), SERIES_PART)
    cells = spread(placed, "block", "span").select("block", "span", "tier", "var", "number", F.inline("cells"))
    times = cells.groupBy("block", "span", "tier", "var", "time").agg(
        F.sort_array(F.collect_list(F.struct("number", "counts", "total"))).alias("cells"))
    times = times.select("block", "span", "tier", "var", "time", _by_number("counts", "bigint"), _by_number("total", "double"))

    entries = [F.get("near", F.lit(i)) for i in range(most)]
    numbers = [F.array_position("spots", F.struct(e["source"], e["loc_id"])) - 1 for e in entries]
    members = blocks.hint("merge").join(spots, "block").select(
        "block", "req_id", F.size("near").cast("bigint").alias("k"),
        *[n.cast("int").alias(f"_number_{i}") for i, n in enumerate(numbers)],
        *[e["weight"].alias(f"_weight_{i}") for i, e in enumerate(entries)])

    def at(name: str, i: int) -> Column:
        return F.get(name, F.col(f"_number_{i}"))

    counts = sum((F.coalesce(at("counts", i), F.lit(0)) for i in range(most)), F.lit(0).cast("bigint"))
    products = [at("total", i) * F.col(f"_weight_{i}") for i in range(most)]
    total = sum((F.coalesce(p, F.lit(0.0)) for p in products), F.lit(0.0))
    value = F.when(F.coalesce(F.lit(None), *products).isNotNull(), total)
    met = times.hint("merge").join(spread(members.crossJoin(spans), "block", "span"), ["block", "span"])
    return met.filter(F.shiftright(counts, 32) == F.col("k")).select(
        "req_id", "tier", "var", "time",
        F.when(counts == F.shiftleft("k", 32) + F.col("k"), value).alias("value"))
