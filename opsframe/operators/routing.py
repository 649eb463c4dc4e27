"""Corridor reroutes, hazard ranking and lane routing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.functions.text import lookup
from opsframe.sources.scratch import written

# Words used in manifests.
HAZARD_FREE = "none"
HAZARD_UNKNOWN = "unknown"
RANK = "decimal(38,0)"  # Levels have any number of digits.
HAZARD_RANKS = {"none": 0, "unknown": 1, "radiological": 2}
BIOHAZARD = "biohazard-"
#: A trip with more open corridors than so many times k at its quieter end is expanded in rounds.
FEW = 32
GROWTH = 4
QUARANTINE_FLAGS = ("expired_certification", "biohazard_present", "origin_not_registered")
REVIEW_FLAGS = ("incomplete_declaration",)
EXPIRED = "expired"


def corridor_costs(legs: DataFrame, origin: str, destination: str, cost: str) -> DataFrame:
    """(origin, destination, cost): the cheapest leg per corridor."""
    return legs.groupBy(
        F.col(origin).alias("origin"), F.col(destination).alias("destination")
    ).agg(F.min(cost).alias("cost"))


def reroute(
    trips: DataFrame, edges: DataFrame, closed: DataFrame, k: int, trip_id: str | None = None
) -> DataFrame:
    """The k cheapest two-leg alternatives of every trip over a closed corridor.

    ``edges`` has one row per corridor (``corridor_costs``), ``trips`` and
    ``closed`` hold (origin, destination). A closed trip is extended from its
    end with fewer open corridors, over the first leg or the second, and the
    other leg is then met on both its ends: a hub that most corridors touch
    costs a trip no more than the quiet end of that trip. Trips between two hubs
    go by ``cheapest_first``. ``rank <= k`` is applied per task before the rows
    are shuffled. With ``trip_id`` every trip
    keeps its rows, under its id; alternatives are still made once per corridor.
    Pass stored ``edges`` (``scratch.written``): several branches read them.
    """
    pair = ["origin", "destination"]
    closed = written(closed.select(*pair).distinct(), "closed")
    subjects = trips.select(*pair).distinct().join(closed, pair, "left_semi")
    open_edges = edges.filter(F.col("origin") != F.col("destination"))
    usable = written(open_edges.join(closed, pair, "left_anti"), "usable")
    departures = usable.groupBy("origin").agg(F.count(F.lit(1)).alias("n_out"))
    arrivals = usable.groupBy("destination").agg(F.count(F.lit(1)).alias("n_in"))
    sized = subjects.join(departures, "origin").join(arrivals, "destination")
    sized = written(sized, "trips")
    first = usable.select("origin", F.col("destination").alias("via"), F.col("cost").alias("cost_1"))
    second = usable.select(F.col("origin").alias("via"), "destination", F.col("cost").alias("cost_2"))
    busy = F.least("n_out", "n_in") > FEW * k
    hubs = sized.filter(busy).select(*pair)
    sized = sized.filter(~busy)
    from_origin = sized.filter(F.col("n_out") <= F.col("n_in")).select(*pair)
    from_destination = sized.filter(F.col("n_out") > F.col("n_in")).select(*pair)
    legs = ["origin", "destination", "via", "cost_1", "cost_2"]
    options = (
        from_origin.join(first, "origin")
        .join(second, ["via", "destination"])
        .select(*legs)
        .unionAll(
            from_destination.join(second, "destination").join(first, ["origin", "via"]).select(*legs)
        )
        .withColumn("cost", F.col("cost_1") + F.col("cost_2"))
    )
    if not hubs.isEmpty():
        options = options.unionAll(cheapest_first(hubs, usable, k).select(*options.columns))
    order = Window.partitionBy(*pair).orderBy("cost", "via")
    ranked = (
        options.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(*legs, "cost", "rank")
    )
    if trip_id is None:
        return ranked
    # A corridor of very many trips is on the plain side, which AQE splits.
    mine = trips.select(trip_id, *pair).distinct()
    return mine.join(written(ranked, "alternatives"), pair).select(trip_id, *legs, "cost", "rank")


def cheapest_first(trips: DataFrame, usable: DataFrame, k: int) -> DataFrame:
    """The k cheapest two-leg ways of each trip: origin, destination, via, cost_1, cost_2, cost.

    ``trips`` and ``usable`` are stored tables of (origin, destination) and, for the
    open corridors, cost. In a round every open trip sees the cheapest corridors of
    both its ends, of each so many, and looks up their other legs. Any way not seen
    costs at least the dearest corridor seen at either end together; a trip whose
    k-th best is below that is settled, as is one that has seen all of an end. The
    others go on to a round with ``GROWTH`` times as many.
    """
    pair, legs = ["origin", "destination"], ["origin", "destination", "via", "cost_1", "cost_2", "cost"]
    settled, left, many = [], trips, 2 * k

    def cheapest(end: str, other: str, n: int) -> tuple[DataFrame, DataFrame]:
        """The n cheapest corridors of each end of a trip, and (end, dearest of them, how many)."""
        mine = usable.join(left.select(end).distinct(), end, "left_semi")
        ranked = mine.withColumn("place", F.row_number().over(Window.partitionBy(end).orderBy("cost", other)))
        seen = written(ranked.filter(F.col("place") <= n).drop("place"), f"cheapest-{end}")
        return seen, seen.groupBy(end).agg(F.max("cost").alias(f"most_{end}"), F.count("*").alias(f"n_{end}"))

    while True:
        (out, most_out), (into, most_in) = cheapest("origin", "destination", many), cheapest("destination", "origin", many)
        first = out.select("origin", F.col("destination").alias("via"), F.col("cost").alias("cost_1"))
        second = into.select(F.col("origin").alias("via"), "destination", F.col("cost").alias("cost_2"))
        every_first = usable.select("origin", F.col("destination").alias("via"), F.col("cost").alias("cost_1"))
        every_second = usable.select(F.col("origin").alias("via"), "destination", F.col("cost").alias("cost_2"))
        ways = (
            left.join(first, "origin").join(every_second, ["via", "destination"]).select(*legs[:5])
            .unionAll(left.join(second, "destination").join(every_first, ["origin", "via"]).select(*legs[:5]))
            .distinct().withColumn("cost", F.col("cost_1") + F.col("cost_2"))
        )
        best = Window.partitionBy(*pair).orderBy("cost", "via")
        ways = written(ways.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k), "ways")
        last = ways.filter(F.col("_n") == k).select(*pair, F.col("cost").alias("_kth"))
        whole = (F.col("n_origin") < many) | (F.col("n_destination") < many)
        bounds = left.join(most_out, "origin").join(most_in, "destination").join(last, pair, "left")
        # Equal is not below: an unseen way of the same cost might go first by its via.
        below = F.coalesce(F.col("_kth") < F.col("most_origin") + F.col("most_destination"), F.lit(False))
        closed = written(bounds.withColumn("_done", whole | below).select(*pair, "_done"), "bounds")
        settled.append(ways.join(closed.filter("_done").select(*pair), pair, "left_semi").select(*legs))
        left = closed.filter(~F.col("_done")).select(*pair)
        if left.isEmpty():
            break
        many *= GROWTH
    found = settled[0]
    for more in settled[1:]:
        found = found.unionAll(more)
    return found


def hazard_rank(hazard: Column, ranks: Mapping[str, int] = HAZARD_RANKS) -> Column:
    """The word's rank, and above all of them biohazard-n by n; other words count as unknown."""
    first_level = max(ranks.values()) + 1
    digits = F.substr(hazard, F.lit(len(BIOHAZARD) + 1))
    highest = F.lit("9" * 37).cast("decimal(37,0)")
    level = F.coalesce(digits.try_cast("decimal(37,0)"), highest)
    graded = F.when(
        hazard.startswith(BIOHAZARD) & digits.rlike("^[0-9]+$"), level + F.lit(first_level)
    )
    known = lookup(hazard, dict(ranks)).cast(RANK)
    return F.coalesce(known, graded.cast(RANK), F.lit(ranks[HAZARD_UNKNOWN]).cast(RANK))


def with_hazard(manifests: DataFrame, ranks: Mapping[str, int] = HAZARD_RANKS) -> DataFrame:
    """Adds ``hazard_rank``, ``worst_item`` and ``worst_class`` of every manifest.

    The worst is taken inside the row; a manifest without items has rank -1.
    """
    ranked = F.transform(
        F.coalesce("declared_items", F.array()),
        lambda i: F.struct(
            hazard_rank(i["hazard_class"], ranks).alias("hazard_rank"),
            i["item"].alias("worst_item"),
            i["hazard_class"].alias("worst_class"),
        ),
    )
    absent = F.lit(None).cast("string")
    nothing = F.struct(
        F.lit(-1).cast(RANK).alias("hazard_rank"), absent.alias("worst_item"), absent.alias("worst_class")
    )
    # inline() yields the fields of one struct, which is then computed only once.
    return manifests.select("*", F.inline(F.array(F.coalesce(F.array_max(ranked), nothing))))


def max_hazard(
    manifests: DataFrame, ranks: Mapping[str, int] = HAZARD_RANKS, key: str = "manifest_id"
) -> DataFrame:
    """The one manifest with the highest declared hazard, ties by key."""
    return with_hazard(manifests, ranks).orderBy(F.col("hazard_rank").desc(), key).limit(1)


def lane_of() -> Column:
    """The one lane of a manifest row, first match in this order.

    quarantine: a declared hazard, an expired certificate, or a flag for one of
    these or for an unregistered origin. customs_review: nothing declared,
    missing or unknown hazard classes (words off the list among them), missing
    paperwork, or any other flag. fast_lane: everything else.
    """
    items, flags = F.col("declared_items"), F.col("customs_flags")

    def hazardous(item: Column) -> Column:
        return hazard_rank(item["hazard_class"]) > HAZARD_RANKS[HAZARD_UNKNOWN]

    def unclear(item: Column) -> Column:
        return hazard_rank(item["hazard_class"]) == HAZARD_RANKS[HAZARD_UNKNOWN]

    def yes(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    quarantine = (
        yes(F.exists(items, hazardous))
        | yes(F.col("pilot_certification") == EXPIRED)
        | yes(F.arrays_overlap(flags, F.array(*map(F.lit, QUARANTINE_FLAGS))))
    )
    review = (
        F.coalesce(F.size(items) < 1, F.lit(True))
        | yes(F.exists(items, unclear))
        | F.col("pilot_certification").isNull()
        | F.coalesce(F.size(flags) > 0, F.lit(False))
    )
    return F.when(quarantine, "quarantine").when(review, "customs_review").otherwise("fast_lane")


def route_lane(manifests: DataFrame) -> DataFrame:
    """Adds ``lane``: a projection without shuffle, so it also runs on a stream."""
    return manifests.withColumn("lane", lane_of())
