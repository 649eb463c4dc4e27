"""Every operator as a query over the order warehouse tables.

Each query takes (spark, folder of Parquet tables) and reads whole tables.
Queries that exercise a source or sink first let Spark write the table in that
format to the shared folder. Results are flat and rounded, so that another SQL
engine can reproduce them exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.functions import records, text
from opsframe.functions.shapes import BIGINT, BOOLEAN, DATE, DOUBLE, TEXT, shape
from opsframe.operators import (
    answers,
    digests,
    drift,
    guarded,
    inference,
    lines,
    observe,
    relational,
    requests,
    review,
    routing,
)
from opsframe.plans import reports
from opsframe.sources import files, large, manifests, tables
from opsframe.sources.scratch import shared_dir, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _instant(col: str) -> F.Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# ---- manifests built from orders ------------------------------------------

HAZARDS = {
    ("N", "F"): "none",
    ("N", "O"): "none",
    ("A", "F"): "none",
    ("A", "O"): "unknown",
    ("R", "F"): "radiological",
    ("R", "O"): "biohazard-2",
}
OTHER = "other"


def order_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """One manifest per order, one declared item per return flag and line status.

    Pairs that are not listed are one item of unknown class. An item is there
    if the order has a line of it, whatever the quantities. They are summed per
    order before nesting, so a list has at most seven items however many lines
    an order has.
    """
    lines = table(spark, folder, "lineitem")
    pair = F.concat_ws("/", "l_returnflag", "l_linestatus")
    classes = {f"{flag}/{status}": hazard for (flag, status), hazard in HAZARDS.items()}
    lines = lines.withColumn("pair", F.when(pair.isin(*classes), pair).otherwise(OTHER))
    classes[OTHER] = routing.HAZARD_UNKNOWN
    sums = [
        sum_
        for item in classes
        for sum_ in (
            F.sum(F.when(F.col("pair") == item, F.col("l_quantity"))).alias(f"sum {item}"),
            F.count_if(F.col("pair") == item).alias(f"count {item}"),
        )
    ]
    items = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"count {item}") > 0,
                    F.struct(
                        F.lit(item).alias("item"),
                        F.col(f"sum {item}").alias("tonnes"),
                        F.lit(hazard).alias("hazard_class"),
                    ),
                )
                for item, hazard in classes.items()
            ]
        )
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    per_order = lines.groupBy("l_orderkey").agg(*sums).select("l_orderkey", items.alias("items"))
    # As many rows as orders: never worth a broadcast, whatever the estimate says.
    joined = orders.join(per_order.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    incomplete = F.array(F.lit("incomplete_declaration"))
    return joined.select(
        F.col("o_orderkey").cast("string").alias("manifest_id"),
        F.col("o_orderpriority").alias("origin_station"),
        F.col("o_orderstatus").alias("destination_station"),
        F.coalesce("items", F.array()).alias("declared_items"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"), "expired")
        .otherwise("current")
        .alias("pilot_certification"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", incomplete)
        .otherwise(F.array().cast("array<string>"))
        .alias("customs_flags"),
    )


# ---- sources and sinks ------------------------------------------------------

ORDERS = shape(
    o_orderkey=BIGINT,
    o_custkey=BIGINT,
    o_orderstatus=TEXT,
    o_totalprice=DOUBLE,
    o_orderdate=DATE,
    o_orderpriority=TEXT,
)


def _as_csv(frame: DataFrame, purpose: str) -> str:
    path = shared_dir(frame.sparkSession, purpose)
    frame.write.option("header", True).csv(path)
    return path


@query
def s1_load_table(spark: SparkSession, folder: str) -> DataFrame:
    """Orders through a CSV whose columns stand in another order."""
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    path = _as_csv(orders.select(*reversed(ORDERS.names)), "orders-csv")
    loaded = tables.load_table(spark, path, ORDERS)
    return loaded.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query
def s1_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Flags written as words: 'true' and 'false' are read, an empty cell and any other word are none."""
    customer = table(spark, folder, "customer")
    word = F.when(F.col("c_acctbal") > 100, "true").when(F.col("c_acctbal") < -100, "false").when(
        F.col("c_acctbal") > 0, "yes"
    )
    path = _as_csv(customer.select(word.alias("active"), "c_custkey"), "flags-csv")
    schema = shape(c_custkey=BIGINT, active=BOOLEAN)
    loaded = tables.load_table(spark, path, schema)
    bad = tables.rejected_rows(spark, path, schema).select(F.col("c_custkey").cast("bigint").alias("_bad"))
    return loaded.join(bad, F.col("c_custkey") == F.col("_bad"), "left").select(
        "c_custkey", "active", F.col("_bad").isNotNull().alias("rejected")
    )


@query
def s1_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """What a CSV of orders reports where rows have surplus, missing or unreadable cells."""
    key, cells = F.col("o_orderkey"), ["o_orderkey", "o_custkey", "o_orderstatus"]
    row = (
        F.when(key % 97 == 0, F.concat_ws(",", *cells, F.lit("surplus")))
        .when(key % 89 == 0, F.concat_ws(",", *cells[:2]))
        .when(key % 83 == 0, F.concat_ws(",", key, F.lit("none"), "o_orderstatus"))
        .otherwise(F.concat_ws(",", *cells))
    )
    path = shared_dir(spark, "broken-csv")
    rows = table(spark, folder, "orders").select(row.alias(",".join(cells)))
    rows.write.option("header", True).option("sep", "\t").csv(path)
    schema = shape(o_orderkey=BIGINT, o_custkey=BIGINT, o_orderstatus=TEXT)
    return tables.rejected_rows(spark, path, schema).select(
        "o_orderkey",
        F.array_join("bad_columns", ",").alias("bad_columns"),
        F.col(tables.BROKEN).alias("broken"),
    )


REFRESHED = ("region", "nation", "supplier", "customer", "part", "orders")


@query
def s2_refresh_counts(spark: SparkSession, folder: str) -> DataFrame:
    specs = {}
    for name in REFRESHED:
        frame = table(spark, folder, name)
        specs[name] = (_as_csv(frame, f"{name}-csv"), frame.schema)
    return tables.refresh_tables(spark, specs, shared_dir(spark, "refreshed"))


@query
def s2_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each table in the version before and the current one, of which the last has no small keys."""
    out, counts = shared_dir(spark, "versions"), []
    for name, key in (("nation", "n_nationkey"), ("customer", "c_custkey"), ("orders", "o_orderkey")):
        frame = table(spark, folder, name)
        for rows in (frame, frame.filter(F.col(key) >= 10)):
            tables.refresh_versions(spark, {name: (_as_csv(rows, f"{name}-csv"), frame.schema)}, out)
        before, now = tables.versions(spark, out, name)
        for version in (before, None):
            found = tables.read_version(spark, out, name, frame.schema, version)
            label = F.lit("before" if version else "current")
            counts.append(found.agg(F.lit(name).alias("table"), label.alias("version"), F.count("*").alias("rows")))
    every = counts[0]
    for more in counts[1:]:
        every = every.unionAll(more)
    return every


@query
def s3_registered_join(spark: SparkSession, folder: str) -> DataFrame:
    """Three formats as views: CSV nations, JSON customers, Parquet orders."""
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    customers = shared_dir(spark, "customer-json")
    customer.write.json(customers)
    tables.register_sources(
        spark,
        [
            tables.Source("registered_nation", _as_csv(nation, "nation-csv"), "csv", nation.schema),
            tables.Source("registered_customer", customers, "json", customer.schema),
            tables.Source("registered_orders", f"{folder}/orders.parquet"),
        ],
    )
    return spark.sql(
        """
        SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
        FROM registered_orders
        JOIN registered_customer ON o_custkey = c_custkey
        JOIN registered_nation ON c_nationkey = n_nationkey
        GROUP BY n_name
        """
    )


@query
def s4_list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths and numbers of the files that hold the documents, one per source."""
    out = shared_dir(spark, "documents-by-source")
    docs = table(spark, folder, "documents").select("doc_id", "source")
    docs.repartition("source").write.partitionBy("source").parquet(out)
    listed = files.list_files(spark, out)
    # The last name is the writer's own; a task that ran twice would change it.
    shown = F.regexp_replace("path", r"[^/]*\.parquet$", "*.parquet")
    return listed.filter(F.col("length") > 0).groupBy(shown.alias("path")).agg(
        F.count("*").alias("n_files")
    )


@query
def s4_hidden_files(spark: SparkSession, folder: str) -> DataFrame:
    """How many files hold the documents of each source, in folders that Spark itself does not list."""
    out = shared_dir(spark, "documents-hidden")
    docs = table(spark, folder, "documents").select("doc_id", "source")
    hidden = F.when(F.length("source") % 2 == 0, F.concat(F.lit("_"), "source")).otherwise(F.concat(F.lit("."), "source"))
    docs.withColumn("at", hidden).repartition("at").write.partitionBy("at").parquet(f"{out}/.parts")
    listed = files.list_files(spark, out, hidden=True).filter(F.col("path").rlike(r"/part-[^/]*\.parquet$"))
    return listed.groupBy(F.regexp_extract("path", r"^\.parts/at=([^/]*)/part-", 1).alias("at")).agg(
        F.count("*").alias("n_files"), (F.min("length") > 0).alias("filled")
    )


@query
def s5_large_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Characters of text files of all documents, whatever splits and pieces they are read in."""
    out = shared_dir(spark, "documents-large")
    # A file for each split of the table: what a task writes does not grow with it.
    table(spark, folder, "documents").select(files.plain_lines(F.col("text")).alias("text")).write.text(out)
    read = large.read_large_texts(spark, out, max_chars=10_000)
    n, piece = F.length("text"), F.col("piece")
    # Combined before the shuffle: the pieces of a file do not meet in one task.
    sizes = read.groupBy("path").agg(
        F.sum(n).alias("n"), F.max(piece).alias("last"), F.min(F.when(n != 10_000, piece)).alias("first_short")
    )
    return sizes.agg(
        F.sum("n").alias("n_chars"), (F.count_if(F.col("first_short") < F.col("last")) == 0).alias("full")
    )


@query
def s5_text_files(spark: SparkSession, folder: str) -> DataFrame:
    """How often each line occurs in whole text files of up to 100 documents."""
    out = shared_dir(spark, "documents-text")
    table(spark, folder, "documents").select("text").write.option("maxRecordsPerFile", 100).text(out)
    read = files.read_text_files(spark, out)
    lines = read.select(F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line") != "")
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query
def s5_text_capped(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in numbered pieces of at most 4,096 characters."""
    docs = table(spark, folder, "documents")
    return files.in_pieces(docs.select("doc_id", files.plain_lines(F.col("text")).alias("text")), 4096)


@query
def s6_manifests(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_dir(spark, "manifests-json")
    order_manifests(spark, folder).write.json(out)
    loaded = manifests.load_manifests(spark, out, one_per_file=False)
    tonnes = F.aggregate("declared_items", F.lit(0.0), lambda total, i: total + F.coalesce(i["tonnes"], F.lit(0.0)))
    return loaded.select(
        "manifest_id",
        "pilot_certification",
        F.size("declared_items").alias("n_items"),
        tonnes.alias("tonnes"),
        F.array_join(F.col("declared_items.hazard_class"), ",").alias("hazards"),
        F.array_join("customs_flags", ",").alias("flags"),
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
    )


@query
def s6_manifest_files(spark: SparkSession, folder: str) -> DataFrame:
    """One manifest file per nation, over several lines; those of region 2 are cut off."""
    nation, customer = table(spark, folder, "nation"), table(spark, folder, "customer")
    per_item = customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").cast("double").alias("tonnes"))
    item = F.struct(F.col("c_mktsegment").alias("item"), "tonnes", F.lit("none").alias("hazard_class"))
    declared = per_item.groupBy("c_nationkey").agg(F.sort_array(F.collect_list(item)).alias("declared_items"))
    named = nation.join(declared, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    text_of = F.to_json(F.struct(F.col("n_name").alias("manifest_id"), "declared_items"))
    lines = F.replace(text_of, F.lit(","), F.lit(",\n"))
    cut = F.when(F.col("n_regionkey") == 2, F.left(lines, F.length(lines) - 1)).otherwise(lines)
    out = shared_dir(spark, "manifest-files")
    files_of = named.select(cut.alias("value"), F.col("n_nationkey").alias("file"))
    files_of.repartition("file").write.partitionBy("file").text(out)
    loaded = manifests.load_manifests(spark, out)
    tonnes = F.aggregate("declared_items", F.lit(0.0), lambda total, i: total + i["tonnes"])
    return loaded.select(
        F.col("file").cast("int").alias("file"),
        "manifest_id",
        F.when(F.col("_corrupt_record").isNull(), tonnes).alias("tonnes"),
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
    )


@query
def s7_read_lane(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_dir(spark, "lanes")
    manifests.write_by_lane(routing.route_lane(order_manifests(spark, folder)), out)
    return manifests.read_lane(spark, out, "customs_review").select("manifest_id", "lane")


@query
def s7_lane_counts(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_dir(spark, "lanes")
    manifests.write_by_lane(routing.route_lane(order_manifests(spark, folder)), out)
    return spark.read.parquet(out).groupBy("lane").agg(F.count(F.lit(1)).alias("n"))


@query
def s8_pick_one(spark: SparkSession, folder: str) -> DataFrame:
    return manifests.pick_one(table(spark, folder, "documents").select("doc_id"), "doc_id", 7)


# ---- relational ---------------------------------------------------------------


@query
def r1_scan(spark: SparkSession, folder: str) -> DataFrame:
    return relational.scan(table(spark, folder, "nation"))


@query
def r2_filter_optional(spark: SparkSession, folder: str) -> DataFrame:
    found = relational.filter_optional(table(spark, folder, "orders"), "o_orderstatus", "P")
    return found.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query
def r2_filter_absent(spark: SparkSession, folder: str) -> DataFrame:
    found = relational.filter_optional(table(spark, folder, "orders"), "o_orderstatus", "")
    return found.select("o_orderkey", "o_orderstatus")


def _suppliers_of_region(spark: SparkSession, folder: str) -> DataFrame:
    """All suppliers, with the nation name only inside the region AMERICA."""
    region = table(spark, folder, "region").filter(F.col("r_name") == "AMERICA")
    nation = table(spark, folder, "nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi"
    )
    return table(spark, folder, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )


@query
def r3_count_by_unknown(spark: SparkSession, folder: str) -> DataFrame:
    return relational.count_by(_suppliers_of_region(spark, folder), "n_name")


@query
def r4_top_groups(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier")
    return relational.top_groups(supplier, "s_nationkey", F.col("s_acctbal") > 0)


@query
def r5_counts_json(spark: SparkSession, folder: str) -> DataFrame:
    operational = _suppliers_of_region(spark, folder).filter(F.col("s_acctbal") > 0)
    return relational.counts_as_json(operational, "n_name", buckets=2)


@query
def r6_topk(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return relational.top_k(orders, "o_totalprice", 5, ["o_orderkey"], F.col("o_orderstatus") == "O")


@query
def r7_topk_join(spark: SparkSession, folder: str) -> DataFrame:
    """The dearest lines whose supplier is operational."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return relational.top_k_joined(
        table(spark, folder, "lineitem").select(*columns),
        table(spark, folder, "supplier"),
        ("l_suppkey", "s_suppkey"),
        F.col("s_acctbal") > 0,
        "l_extendedprice",
        3,
        columns[:4],
    )


@query
def r7_answer(spark: SparkSession, folder: str) -> DataFrame:
    """The largest orders as one answer record."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("route_name"), "o_totalprice"
    )
    answer = reports.route_answer("Which orders are the largest?", orders, "o_totalprice", 4)
    return answer.withColumn("top_routes", F.array_join("top_routes", ","))


@query
def r8_count_where(spark: SparkSession, folder: str) -> DataFrame:
    return relational.count_where(table(spark, folder, "orders"), F.col("o_orderstatus") == "P")


@query
def r9_mean_converted(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return relational.mean_converted(orders, "o_totalprice", 24, 2, F.col("o_orderstatus") == "O")


LICENCES = {
    "MACHINERY": ("heavy_transport", "freighter"),
    "AUTOMOBILE": ("heavy_transport", "courier"),
    "BUILDING": ("freighter",),
    "FURNITURE": ("courier",),
}


@query
def r10_qualified_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Qualified customers, with the suppliers of their nation that have evidence."""
    evidence = table(spark, folder, "lineitem").filter(
        (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.1) & (F.col("l_tax") >= 0.08)
    )
    per_home = relational.evidence_per_home(
        table(spark, folder, "supplier"), "s_suppkey", "s_nationkey", evidence, "l_suppkey"
    )
    people = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return relational.qualified_with_evidence(
        people, "c_mktsegment", "c_nationkey", LICENCES, "heavy_transport", per_home
    )


def _people_and_evidence(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    people = relational.qualified(customer, "c_mktsegment", LICENCES, "heavy_transport")
    urgent = table(spark, folder, "orders").filter(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    )
    return people, urgent


@query
def r10_semi(spark: SparkSession, folder: str) -> DataFrame:
    people, urgent = _people_and_evidence(spark, folder)
    return relational.keep_evidenced(people, urgent, ("c_custkey", "o_custkey"))


@query
def r10_anti(spark: SparkSession, folder: str) -> DataFrame:
    people, urgent = _people_and_evidence(spark, folder)
    return relational.keep_evidenced(people, urgent, ("c_custkey", "o_custkey"), present=False)


def _corridors(spark: SparkSession, folder: str) -> DataFrame:
    """(origin, destination, cost): quantity shipped between nations."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("origin"), F.col("s_nationkey").alias("destination"))
        .agg(F.sum("l_quantity").alias("cost"))
    )


@query
def r11_reroute(spark: SparkSession, folder: str) -> DataFrame:
    """Alternatives to the closed corridors from EUROPE to ASIA."""
    named = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    leaving = named.filter(F.col("r_name") == "EUROPE").select(F.col("n_nationkey").alias("origin"))
    arriving = named.filter(F.col("r_name") == "ASIA").select(F.col("n_nationkey").alias("destination"))
    edges = written(_corridors(spark, folder), "corridors")
    closed = edges.join(leaving, "origin", "left_semi").join(arriving, "destination", "left_semi")
    return routing.reroute(closed, edges, closed, 3)


@query
def r12_hazard_ranks(spark: SparkSession, folder: str) -> DataFrame:
    ranked = routing.with_hazard(order_manifests(spark, folder))
    rank = F.col("hazard_rank").cast("int").alias("hazard_rank")
    return ranked.select("manifest_id", rank, "worst_item", "worst_class")


@query
def r12_max_hazard(spark: SparkSession, folder: str) -> DataFrame:
    worst = routing.max_hazard(order_manifests(spark, folder))
    return worst.select("manifest_id", F.col("hazard_rank").cast("int").alias("hazard_rank"), "worst_class")


@query
def r13_route_lane(spark: SparkSession, folder: str) -> DataFrame:
    return routing.route_lane(order_manifests(spark, folder)).select("manifest_id", "lane")


@query
def r14_numbered(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of every document, numbered."""
    lines = table(spark, folder, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return relational.numbered(lines, "lines")


@query
def r14_joined(spark: SparkSession, folder: str) -> DataFrame:
    """Every manifest's declared items on one line."""
    listed = order_manifests(spark, folder).withColumn("items", F.col("declared_items.item"))
    return listed.select("manifest_id", relational.joined_list("items").alias("items"))


# ---- drift ---------------------------------------------------------------------

PART_DRIFT = (
    drift.Change("p_partkey", "id", "bigint"),
    drift.Change("p_name", "title", "string"),
    drift.Change("p_brand", "maker", "string"),
    drift.Change("p_type", "kind", "string"),
    drift.Change("p_size", "dimension", "double"),
    drift.Change("p_retailprice", "price_mils", "double", 1000.0),
)


def _parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, folder, "part")
    return part, drift.project_drift(part, PART_DRIFT)


@query
def d1_project_drift(spark: SparkSession, folder: str) -> DataFrame:
    return _parts(spark, folder)[1]


@query
def d2_match_columns(spark: SparkSession, folder: str) -> DataFrame:
    return drift.match_columns(*_parts(spark, folder)).withColumn("score", F.round("score", 6))


@query
def d2_match_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Column pairs whose estimated overlap is over a half."""
    return drift.match_columns_sketched(*_parts(spark, folder), 0.5).select("col_a", "col_b")


@query
def d3_unit_drift(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    other = orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("buyer"),
        (F.col("o_totalprice") * F.lit(1000.0)).alias("price_mils"),
    )
    pairs = [("o_totalprice", "price_mils"), ("o_custkey", "buyer"), ("o_totalprice", "buyer")]
    report = drift.unit_drift(orders, other, ("o_orderkey", "id"), pairs)
    for ratio in ("min_ratio", "max_ratio"):
        report = report.withColumn(ratio, F.round(ratio, 6))
    return report


@query
def d3_affine(spark: SparkSession, folder: str) -> DataFrame:
    """Prices with a factor and an offset, turned over, unchanged, and unrelated."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    other = orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("buyer"),
        (F.col("o_totalprice") * F.lit(1.8) + F.lit(32.0)).alias("price_f"),
        (F.lit(100.0) - F.col("o_totalprice") / F.lit(4.0)).alias("left_over"),
        F.col("o_totalprice").alias("price"),
    )
    pairs = [("o_totalprice", x) for x in ("price_f", "left_over", "price", "buyer")] + [("o_custkey", "buyer")]
    found = lines.affine_drift(orders, other, ("o_orderkey", "id"), pairs)
    kept = F.col("constant")
    return found.withColumns({c: F.when(kept, F.round(c, 4) + F.lit(0.0)) for c in ("factor", "offset")})


def _part_versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Parts and their drifted copy, with a retyped, a lost and a new column, and one with an offset."""
    part = table(spark, folder, "part")
    group = F.col("p_partkey") % 7
    heat = (F.col("p_partkey") * 37 % 101) / F.lit(8.0) - F.lit(40.0)
    old = part.withColumns(
        {"p_group": group, "p_note": F.concat(F.lit("note "), "p_partkey"), "p_celsius": heat}
    )
    new = part.withColumns(
        {
            "p_group": group.cast("string"),
            "added": F.concat(F.lit("new "), "p_partkey"),
            "fahrenheit": heat * F.lit(1.8) + F.lit(32.0),
        }
    )
    kept = tuple(drift.Change(name, name, "string") for name in ("p_group", "added"))
    return old, drift.project_drift(new, (*PART_DRIFT, *kept, drift.Change("fahrenheit", "fahrenheit", "double")))


@query
def d4_findings(spark: SparkSession, folder: str) -> DataFrame:
    return drift.compatibility_findings(*_part_versions(spark, folder), ("p_partkey", "id"))


@query
def d4_findings_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """The kinds and columns of the findings when shared values are estimated."""
    found = drift.compatibility_findings(
        *_part_versions(spark, folder), ("p_partkey", "id"), sketched=True
    )
    return found.select("kind", "col_a", "col_b")


@query
def d4_compat(spark: SparkSession, folder: str) -> DataFrame:
    report = drift.compatibility_report(*_part_versions(spark, folder), ("p_partkey", "id"))
    return report.select(
        "compatible",
        F.array_join("mismatches", "; ").alias("mismatches"),
        F.array_join("suggested_actions", "; ").alias("suggested_actions"),
    )


def _customer_versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Customers and a copy: debts cleared, one segment moved to other keys, one doubled."""
    customer = table(spark, folder, "customer")
    moved = F.col("c_mktsegment") == "MACHINERY"
    copy = customer.select(
        F.when(moved, -1 - F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("c_custkey"),
        F.concat(F.lit("\n "), "c_name", F.lit("\t")).alias("c_name"),
        "c_nationkey",
        F.greatest("c_acctbal", F.lit(0.0)).alias("c_acctbal"),
        "c_mktsegment",
    )
    doubled = F.when(F.col("c_mktsegment") == "BUILDING", 2).otherwise(1)
    return customer, copy.withColumn("_", F.explode(F.array_repeat(F.lit(1), doubled))).drop("_")


@query
def d5_diff_keyed(spark: SparkSession, folder: str) -> DataFrame:
    return drift.diff_tables(*_customer_versions(spark, folder), ["c_custkey"])


@query
def d5_diff_digests(spark: SparkSession, folder: str) -> DataFrame:
    """The same differences, found through digests of buckets."""
    return digests.diff_digests(*_customer_versions(spark, folder), ["c_custkey"])


@query
def d5_except_all(spark: SparkSession, folder: str) -> DataFrame:
    """Orders against a copy with pending ones dropped and finished ones doubled."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    copies = F.when(F.col("o_orderstatus") == "F", 2).otherwise(1)
    copy = orders.filter(F.col("o_orderstatus") != "P").withColumn("_", F.explode(F.array_repeat(F.lit(1), copies)))
    return drift.diff_rows(orders, copy.drop("_"))


def _close(estimate: str, exact: str) -> F.Column:
    """Within five per cent."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.col(exact) * F.lit(0.05)


@query
def d2_estimates_close(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the sketched counts and overlaps of matching columns are near the exact ones."""
    exact = drift.match_columns(*_parts(spark, folder), 0.5)
    sketched = drift.match_columns_sketched(*_parts(spark, folder), 0.4).select(
        "col_a", "col_b", *[F.col(n).alias(f"e_{n}") for n in ("n_a", "n_b", "n_common")]
    )
    return exact.join(sketched, ["col_a", "col_b"], "left").select(
        "col_a", "col_b", *[_close(f"e_{n}", n).alias(f"{n}_close") for n in ("n_a", "n_b", "n_common")]
    )


@query
def d6_estimates_close(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the estimated distinct counts of orders are near the exact ones."""
    orders = table(spark, folder, "orders")
    exact = drift.profile(orders).select("column", F.col("n_distinct").alias("exact"))
    estimated = drift.profile(orders, exact=False).select("column", "n_distinct")
    joined = exact.join(estimated, "column")
    return joined.select("column", "exact", _close("n_distinct", "exact").alias("close"))


@query
def d6_profile(spark: SparkSession, folder: str) -> DataFrame:
    return drift.profile(table(spark, folder, "orders"))


@query
def d6_profile_estimated(spark: SparkSession, folder: str) -> DataFrame:
    """The one-pass profile without the estimated column."""
    return drift.profile(table(spark, folder, "lineitem"), exact=False).drop("n_distinct")


# ---- inference -----------------------------------------------------------------

SEVERITY_ANSWERS = (
    ("@", inference.severity_json("critical", "{size} characters", ["contact", "privacy"], "remove the address")),
    ("***", inference.severity_json("high", "{size} characters", ["encoding"], "clean the text")),
    ("Apache", "not a record"),
    ("MIT", inference.severity_json("unclear", "{size} characters", ["licence"], "ask")),
    ("GNU", inference.severity_json("medium", "{size} characters", ["licence"], "keep the notice")),
)
SEVERITY_MODEL = inference.keyword_model(
    SEVERITY_ANSWERS, inference.severity_json("low", "{size} characters", [], "none")
)
LABEL_MODEL = inference.keyword_model(
    (("@", "no idea"), ("***", "quarantine"), ("Licen", "customs_review")), "fast_lane"
)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def _severities(spark: SparkSession, folder: str) -> DataFrame:
    return inference.infer(
        _documents(spark, folder), "text", SEVERITY_MODEL, records.SEVERITY_REPORT
    )


@query
def i1_prompts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    prompts = inference.build_prompts(docs, "Grade this report from {}.\n\n{}", ["source", "text"])
    return prompts.select("doc_id", "prompt")


@query
def i1_record_prompts(spark: SparkSession, folder: str) -> DataFrame:
    brief = table(spark, folder, "nation").withColumn(
        "brief", inference.record_json("n_nationkey", "n_name", "n_regionkey")
    )
    return inference.build_prompts(brief, "Plan for: {}", ["brief"]).select("n_nationkey", "prompt")


@query
def i2_infer(spark: SparkSession, folder: str) -> DataFrame:
    return _severities(spark, folder).select(
        "doc_id",
        "record.severity",
        "record.summary",
        F.array_join("record.affected_systems", ",").alias("systems"),
        F.col("record.recommended_action").alias("action"),
    )


PLAN_MODEL = inference.keyword_model(
    (
        (
            "NATION_1",
            '{"mission_name": "first", "origin": "o", "destination": "d", '
            '"steps": ["load", "fly", "unload"], "estimated_days": 12.5}',
        ),
        ("NATION_2", '{"mission_name": "second", "origin": "o", "steps": []}'),
    ),
    '{"mission_name": "other", "origin": "o", "destination": "d", "steps": ["wait"], "estimated_days": 1}',
)


@query
def i2_mission_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The numbered steps of a plan per nation; briefs without a full plan are left out."""
    valid, _ = reports.mission_plans(table(spark, folder, "nation"), PLAN_MODEL)
    return reports.steps_of(valid, "n_nationkey")


TELEMETRY_MODEL = inference.keyword_model(
    (
        ("latitude 9", '{"signal_grade": "a", "headline": "near", "watch_items": [], "position_line": "{size}"}'),
        ("latitude 1", '{"signal_grade": "z", "headline": "odd", "watch_items": ["w"], "position_line": "p"}'),
        ("latitude 2", '{"signal_grade": "b", "watch_items": ["w", "x"], "position_line": "p"}'),
    ),
    '{"signal_grade": "c", "headline": "far", "watch_items": ["w", "x"], "position_line": "{size}"}',
)


@query
def i2_telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """The checked telemetry record of every event's stored position."""
    payload = F.struct(
        F.struct(
            F.get_json_object("props", "$.k").alias("latitude"),
            F.col("value").cast("string").alias("longitude"),
        ).alias("iss_position")
    )
    stored = table(spark, folder, "events").select("event_id", F.to_json(payload).alias("payload"))
    valid, _ = reports.telemetry_reports(stored, TELEMETRY_MODEL)
    return valid.select(
        "event_id",
        F.col("record.signal_grade").alias("grade"),
        F.col("record.headline").alias("headline"),
        F.array_join("record.watch_items", ",").alias("watch_items"),
        F.col("record.position_line").alias("asked"),
    )


FILE_MODEL = inference.keyword_model(
    (
        ("@", '{"title": "address", "findings": [{"anomaly_type": "address", "confidence": 1.5, "notes": "n"}]}'),
        (
            "***",
            '{"title": "noise", "findings": [{"anomaly_type": "stars", "confidence": 0.5, "notes": "{size}"}, '
            '{"anomaly_type": "noise", "confidence": 0.25, "notes": "n"}]}',
        ),
        ("Licen", '{"title": "licence", "findings": [{"anomaly_type": "licence", "confidence": 1.0, "notes": "n"}]}'),
    ),
    '{"title": "clean", "findings": []}',
)


@query
def i3_file_findings(spark: SparkSession, folder: str) -> DataFrame:
    """The findings of all valid file reports; one with a confidence over 1 is not."""
    valid, _ = reports.file_reports(_documents(spark, folder), FILE_MODEL)
    return reports.findings_of(valid, "doc_id")


@query
def i4_manifest_lanes(spark: SparkSession, folder: str) -> DataFrame:
    """Lanes by a model that reads the manifest as JSON."""
    model = inference.keyword_model(
        (("biohazard", "quarantine"), ("radiological", "isolation"), ("unknown", "customs_review")), "fast_lane"
    )
    lanes = reports.model_lanes(order_manifests(spark, folder), model)
    return lanes.select("manifest_id", "response", "label", "accepted")


@query
def i3_valid(spark: SparkSession, folder: str) -> DataFrame:
    valid, _ = inference.validate(_severities(spark, folder), "record", records.SEVERITY_RULES)
    return valid.select("doc_id", "record.severity", "record.summary")


@query
def i3_rejected(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = inference.validate(_severities(spark, folder), "record", records.SEVERITY_RULES)
    return rejected.select("doc_id", F.array_join("reasons", "; ").alias("reasons"), "response")


CARGO_MODEL = inference.keyword_model(
    (
        ("URGENT", '{"lane": "fast_lane", "reason": "urgent", "risk_score": 0.125}'),
        ("HIGH", '{"lane": "quarantine", "reason": "high", "risk_score": 1.5}'),
        ("LOW", '{"lane": "hold", "reason": "low", "risk_score": 0.5}'),
        ("MEDIUM", '{"lane": "customs_review", "risk_score": 0.25}'),
    ),
    '{"lane": "customs_review", "reason": "{size} characters", "risk_score": 1}',
)


@query
def i3_cargo(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by what the records of their lanes come to: decisions, or reasons for having none."""
    orders = table(spark, folder, "orders")
    asked = inference.build_prompts(orders, "Which lane for {}?", ["o_orderpriority"])
    scored = inference.infer(asked, "prompt", CARGO_MODEL, records.CARGO_DECISION)
    valid, rejected = inference.validate(scored, "record", records.CARGO_DECISION_RULES)
    decided = valid.select("o_orderpriority", "record.lane", "record.reason", "record.risk_score")
    reasons = F.array_join("reasons", "; ").alias("reason")
    refused = rejected.select("o_orderpriority", F.lit(None).cast("string").alias("lane"), reasons, F.lit(None).cast("double").alias("risk_score"))
    return decided.unionAll(refused).groupBy("o_orderpriority", "lane", "reason", "risk_score").agg(
        F.count("*").alias("n_orders")
    )


@query
def i4_label(spark: SparkSession, folder: str) -> DataFrame:
    labelled = inference.infer_label(
        _documents(spark, folder), "text", LABEL_MODEL, records.LANES
    )
    return labelled.select("doc_id", "response", "label", "accepted")


FINDING_RULES = (
    inference.FindingRule("address", "[A-Za-z0-9._]+@[A-Za-z0-9.]+", 0.9, needle="@"),
    inference.FindingRule(
        "licence", "Licen[sc]ed? under [^\n]*|under the [A-Za-z ]*Licen[sc]e", 0.8, needle="Licen"
    ),
    inference.FindingRule("noise", "[*%#$&]{3}", 0.6),
    inference.FindingRule("long_number", "[0-9]{3}[0-9-]*", 0.5),
    inference.FindingRule("noise", "[*%#$&]{3}", 0.6),
)


@query
def i5_findings(spark: SparkSession, folder: str) -> DataFrame:
    return inference.extract_findings(_documents(spark, folder), "text", FINDING_RULES)


@query
def i5_finding_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The findings as report lines."""
    found = inference.extract_findings(_documents(spark, folder), "text", FINDING_RULES)
    return found.select("doc_id", inference.finding_line().alias("line"))


@query
def i6_escalate(spark: SparkSession, folder: str) -> DataFrame:
    return inference.escalate(_severities(spark, folder)).select("doc_id", "record.severity")


@query
def i7_cached(spark: SparkSession, folder: str) -> DataFrame:
    """The answers of a second run, all of them from the cache of the first."""
    cache = shared_dir(spark, "answers")
    docs = _documents(spark, folder)

    def run() -> DataFrame:
        return inference.infer_cached(docs, "text", SEVERITY_MODEL, records.SEVERITY_REPORT, cache)

    run()
    return run().select("doc_id", "response", "record.severity")


@query
def i7_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a cache in buckets, of which half of the answers came in a call before."""
    cache = shared_dir(spark, "bucketed")
    docs = _documents(spark, folder)

    def run(some: DataFrame) -> DataFrame:
        return answers.infer_bucketed(
            some, "text", SEVERITY_MODEL, records.SEVERITY_REPORT, cache, buckets=16, most_levels=1
        )

    run(docs.filter(F.length("text") % 2 == 0))
    run(docs)
    return run(docs).select("doc_id", "response", "record.severity")


def _careful(prompts_model):
    """A factory of a model that fails on requests with an address."""

    def make():
        model = prompts_model()

        def ask(prompts: list[str]) -> list[str]:
            if any("@" in p for p in prompts):
                raise RuntimeError("addresses are not allowed")
            return model(prompts)

        return ask

    return make


@query
def i2_retried(spark: SparkSession, folder: str) -> DataFrame:
    """Every document once: valid, rejected, or given up with its error."""
    docs = _documents(spark, folder)
    answered, given_up = requests.infer_retried(
        docs, "text", _careful(SEVERITY_MODEL), records.SEVERITY_REPORT, attempts=2
    )
    valid, rejected = inference.validate(answered, "record", records.SEVERITY_RULES)
    parts = (
        (valid, "valid", F.col("record.severity")),
        (rejected, "rejected", F.array_join("reasons", "; ")),
        (given_up, "given up", F.col("error")),
    )
    shown = [
        part.select("doc_id", F.lit(outcome).alias("outcome"), detail.alias("detail"), "attempt")
        for part, outcome, detail in parts
    ]
    return shown[0].unionAll(shown[1]).unionAll(shown[2])


@query
def i8_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Positions stored as nested JSON, made from the event fields."""
    events = table(spark, folder, "events")
    payload = F.struct(
        F.struct(
            F.get_json_object("props", "$.k").alias("latitude"),
            F.col("value").cast("string").alias("longitude"),
        ).alias("iss_position")
    )
    stored = events.select("event_id", F.to_json(payload).alias("payload"))
    return inference.parse_position(stored, "payload").drop("payload")


# ---- guarded SQL, review, metrics ------------------------------------------------


@query
def f1_scalars(spark: SparkSession, folder: str) -> DataFrame:
    """Text cells stripped, read, doubled and shown with fixed decimals."""
    events = table(spark, folder, "events")
    cell = F.concat(F.lit("\t "), F.get_json_object("props", "$.k"), F.lit(" \n"))
    return events.select(
        "event_id",
        text.strip(cell).alias("stripped"),
        text.doubled(cell).alias("doubled"),
        text.fixed(F.col("value")).alias("shown"),
        text.doubled(F.col("event_type")).alias("unreadable"),
    )


@query
def g1_guarded(spark: SparkSession, folder: str) -> DataFrame:
    allowed = [tables.Source(n, f"{folder}/{n}.parquet") for n in ("orders", "customer")]
    statement = """
        SELECT c_mktsegment, o_orderdate, count(*) AS n_orders, max(o_totalprice) AS highest_price
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderstatus <> 'default' -- a word that names a database as well
        GROUP BY c_mktsegment, o_orderdate -- one row per segment and day
    """
    found = guarded.guarded_sql(spark, allowed, statement)
    return found.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


DECISIONS = {"purchase": review.APPROVE, "error": review.REJECT, "click": review.CHANGES}


def _review(spark: SparkSession, folder: str, max_iterations: int) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.col("user_id").alias("item"),
        "ts",
        F.col("event_id").alias("seq"),
        text.lookup(F.col("event_type"), DECISIONS).alias("decision"),
    )
    return review.review_state(
        events,
        max_iterations=max_iterations,
        timeout=timedelta(hours=12),
        as_of=datetime(2024, 2, 1),
    )


def _states(states: DataFrame) -> DataFrame:
    return states.select(
        "item", "state", _instant("decided_at").alias("decided_at"), _instant("opened_at").alias("opened_at")
    )


@query
def g2_review_state(spark: SparkSession, folder: str) -> DataFrame:
    return _states(_review(spark, folder, 3))


@query
def g2_review_state_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _states(_review(spark, folder, 1))


@query
def g3_approved(spark: SparkSession, folder: str) -> DataFrame:
    """The events of users whose review ended in approval."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return review.approved_only(events, _review(spark, folder, 3), ("user_id", "item"))


@query
def g4_observed(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics row gathered while another result was computed."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_quantity")
    metrics = {
        "n_rows": F.count(F.lit(1)),
        "quantity": F.sum("l_quantity"),
        "returned": F.count_if(F.col("l_returnflag") == "R"),
    }
    _, step = observe.run_observed(
        lines, "lines", lambda df: df.write.format("noop").mode("overwrite").save(), metrics
    )
    row = [tuple(step.metrics[name] for name in metrics)]
    return spark.createDataFrame(row, "n_rows bigint, quantity double, returned bigint")
