"""Acceptance queries: every operator bound to the driver's tables.

Each query is ``f(spark, root) -> DataFrame`` over whole tables; the
matching DuckDB SQL lives in ``plans.oracle``.  Computed columns carry the
same names in both.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberledger import constants as K
from emberledger.functions.semantics import (
    concat_na,
    in_set,
    na_mean,
    na_sum,
    not_in,
    str_extract,
    str_remove_first,
    sum_or_zero,
    to_int,
    whole_partition,
)
from emberledger.operators import allocation, factors, inventory, meters, models, records, report, report_state
from emberledger.operators.factors import DROP, KEEP
from emberledger.operators.relational import (
    column_range,
    crossing,
    hot_key_join,
    lookup_join,
    when_groups,
    when_map,
)
from emberledger.plans import bindings as B
from emberledger.sources.io import (
    literal_table,
    read_csv_table,
    read_table,
    scratch_dir,
    write_table,
)
from emberledger.sources.publish import Published, publish
from emberledger.sources.rejects import read_csv_with_rejects
from emberledger.sources.workbook import sheet_rows, to_books

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- inputs ----
def act(spark: SparkSession, root: str) -> DataFrame:
    """Activity records: lineitem x (orders x customer) x part.

    A right side is broadcast only when it is small (at test scale all are);
    beyond that the joins are sort-merge joins on their keys, with AQE
    splitting skewed partitions. Orders meets customer first, so that
    lineitem is shuffled once for them and once for part.
    """
    li = read_table(spark, root, "lineitem", reuse=True).select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_linenumber",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    o = read_table(spark, root, "orders", reuse=True).select("o_orderkey", "o_custkey")
    c = read_table(spark, root, "customer", reuse=True).select("c_custkey", "c_mktsegment")
    p = read_table(spark, root, "part", reuse=True).select("p_partkey", "p_type")
    oc = lookup_join(o, c, {"o_custkey": "c_custkey"}, "inner")
    f = lookup_join(li, oc, {"l_orderkey": "o_orderkey"}, "inner", sized_as=o)
    f = lookup_join(f, p, {"l_partkey": "p_partkey"}, "inner")
    return f.select(
        F.col("p_type").alias("activity"),
        F.col("c_mktsegment").alias("entity"),
        F.col("l_returnflag").alias("supercategory"),
        F.year("l_shipdate").cast("int").alias("input_year"),
        F.col("l_quantity").alias("amount"),
        "l_linestatus", "l_discount", "l_tax", "l_linenumber", "l_orderkey",
    )


_lookups: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def _lookup(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The binding's literal lookups are immutable: build each once per session."""
    per_session = _lookups.setdefault(spark, {})
    if name not in per_session:
        per_session[name] = build()
    return per_session[name]


def key_table(spark: SparkSession) -> DataFrame:
    return _lookup(spark, "key", lambda: literal_table(spark, B.KEY_ROWS, B.KEY_SCHEMA))


def factor_table(spark: SparkSession) -> DataFrame:
    return _lookup(spark, "factors", lambda: literal_table(spark, B.FACTOR_ROWS, B.FACTOR_SCHEMA))


def resolved(spark: SparkSession) -> DataFrame:
    return _lookup(
        spark, "resolved", lambda: factors.resolve_factors(key_table(spark), factor_table(spark))
    )


def loss_table(spark: SparkSession) -> DataFrame:
    return _lookup(spark, "loss", lambda: literal_table(spark, B.LOSS_ROWS, B.LOSS_SCHEMA))


def _emission_totals(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_records"),
        sum_or_zero("amount").alias("total_amount"),
        sum_or_zero("total_mtco2e").alias("total_mtco2e"),
    )


# --------------------------------------------------------------- queries ----
def q01_resolve_factors(spark, root):
    pairs = act(spark, root).groupBy("activity", "input_year").agg(
        F.count(F.lit(1)).alias("n_records")
    )
    return lookup_join(pairs, resolved(spark), ["activity", "input_year"], "left", null_safe=True)


def q01_workbook_sheets(spark, root):
    """S1 from workbooks: orders written as workbooks by the tasks that hold
    them, their sheets read back with a declared schema."""
    orders = read_table(spark, root, "orders", reuse=True).select(
        "o_orderkey", F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority"), "o_totalprice",
        "o_orderdate", (F.col("o_totalprice") > 1000).alias("large"),
    )
    return sheet_rows(to_books(orders, "orders"), "orders", orders.schema)


def q02_csv_roundtrip(spark, root):
    nation = read_table(spark, root, "nation", reuse=True)
    region = read_table(spark, root, "region", reuse=True)
    nr = lookup_join(nation, region, {"n_regionkey": "r_regionkey"}, "inner").select(
        "n_nationkey", "n_name", "n_regionkey", F.expr("nullif(r_name, 'ASIA')").alias("r_name")
    )
    path = scratch_dir(spark, "q02")
    write_table(nr, path, "csv", partition_by=["n_regionkey"])
    back = read_csv_table(
        spark, path, "n_nationkey int, n_name string, r_name string, n_regionkey int"
    )
    return back.select("n_nationkey", "n_name", "n_regionkey", "r_name")


def q02_reject_channel(spark, root):
    """S2 with malformed cells: orders written as CSV with a price that is no
    number or a missing date here and there, read back as rows and rejects."""
    o = read_table(spark, root, "orders", reuse=True).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/k")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_custkey") % 5 > 0, F.col("o_orderdate").cast("date").cast("string")).alias("o_orderdate"),
    )
    path = scratch_dir(spark, "q02-rejects")
    write_table(o, path, "csv")
    good, bad = read_csv_with_rejects(
        spark, path, "o_orderkey long, o_totalprice double, o_orderdate date", required=["o_orderdate"]
    )
    good = good.select("o_orderkey", "o_totalprice", "o_orderdate", F.lit(None).cast("string").alias("reason"))
    bad = bad.select(
        F.col("cells")["o_orderkey"].cast("long").alias("o_orderkey"), F.col("cells")["o_totalprice"].try_cast("double").alias("o_totalprice"),
        F.col("cells")["o_orderdate"].cast("date").alias("o_orderdate"), "reason",
    )
    return good.unionByName(bad)


def q02_published(spark, root):
    """K1 as versions: two ledgers are published together, then again with
    later years; readers that opened the first version still see it."""
    led = q08_emissions(spark, root)
    orders = read_table(spark, root, "orders", reuse=True).select("o_orderkey", F.year("o_orderdate").cast("int").alias("input_year"))
    base = scratch_dir(spark, "q02-published")

    def version(last: int) -> Published:
        publish(spark, base, {"totals": (led.where(F.col("input_year") <= last), ["input_year"]),
                              "orders": (orders.where(F.col("input_year") <= last), [])})
        return Published(spark, base)

    parts = []
    for name, v in [("first", version(1996)), ("second", version(1998))]:
        n = v.read("orders").groupBy("input_year").agg(F.count(F.lit(1)).alias("n_orders"))
        t = v.read("totals").groupBy("input_year").agg(F.sum("n_records").alias("n_records"))
        parts.append(n.join(t, "input_year", "full").withColumn("version", F.lit(name)))
    return parts[0].unionByName(parts[1])


def q03_literal_domain(spark, root):
    nation = read_table(spark, root, "nation", reuse=True)
    region = read_table(spark, root, "region", reuse=True)
    counts = lookup_join(nation, region, {"n_regionkey": "r_regionkey"}, "inner").groupBy(
        "r_name"
    ).agg(F.count(F.lit(1)).alias("n_nations"))
    zones = literal_table(spark, B.ZONE_ROWS, B.ZONE_SCHEMA)
    return lookup_join(counts, zones, ["r_name"], "left")


def q04_projection(spark, root):
    o = read_table(spark, root, "orders", reuse=True).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    o = o.withColumnsRenamed({"o_custkey": "customer_key", "o_totalprice": "amount"})
    return o.drop("o_orderdate")


def q05_household_model(spark, root):
    part = read_table(spark, root, "part", reuse=True).select(
        F.col("p_partkey").cast("int").alias("input_year"),
        F.col("p_size").cast("double").alias("total_households"),
        F.lit(0.25).alias("pct_using_heating_oil"),
        F.col("p_retailprice").alias("total_avg_household_heat_oil_use_gal_year"),
    )
    return models.household_fuel_model(part)


def q06_filters(spark, root):
    li = read_table(spark, root, "lineitem", reuse=True)
    return li.where(
        (F.col("l_returnflag") == "R")
        & F.col("l_linestatus").isin("F", "O")
        & F.when(F.col("l_tax") > F.lit(0.04), F.col("l_tax")).isNotNull()
        & (F.col("l_discount") > 0)
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")


def q06_membership(spark, root):
    """Neither test is ever null, so a null value is in no set."""
    li = read_table(spark, root, "lineitem", reuse=True).select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_tax") > 0.04, F.col("l_returnflag")).alias("flag")
    )
    return li.select("*", in_set("flag", ["A", "R"]).alias("is_in"), not_in("flag", ["A", "R"]).alias("is_out"))


def q07_recode(spark, root):
    a = act(spark, root).select("activity", "input_year", "amount")
    m = literal_table(spark, B.RECODE_ROWS, B.RECODE_SCHEMA)
    out = factors.recode_activity(a, m)
    return out.groupBy("activity", "input_year").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("amount").alias("total_amount")
    )


def q08_emissions(spark, root):
    """Flagship: emissions, records and unmatched records by (activity, year)."""
    a = act(spark, root).select("activity", F.col("input_year").alias("ship_year"), "amount")
    e = factors.apply_factors(a, resolved(spark), KEEP, on={"activity": "activity", "ship_year": "input_year"})
    return e.groupBy("activity", F.col("ship_year").alias("input_year")).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col("total_mtco2e").isNull()).alias("n_unmatched"),
        sum_or_zero("amount").alias("total_amount"),
        sum_or_zero("total_mtco2e").alias("total_mtco2e"),
    )


def q08_matched_only(spark, root):
    """D3 with unmatched records dropped."""
    a = act(spark, root).select("activity", "input_year", "amount")
    return _emission_totals(factors.apply_factors(a, resolved(spark), DROP), ["activity", "input_year"])


def q08_hot_keys(spark, root):
    """J1 above the broadcast limit with a key that holds over half of the
    records: they meet that key's lookup rows without a shuffle."""
    li = read_table(spark, root, "lineitem", reuse=True).select(
        F.when(F.col("l_linenumber") > 2, F.col("l_partkey")).when(F.col("l_quantity") > 3, F.lit(1)).alias("part"), "l_quantity"
    )
    p = read_table(spark, root, "part", reuse=True).select("p_partkey", "p_type")
    out = hot_key_join(li, p, {"part": "p_partkey"}, "left")
    return out.groupBy(F.col("p_type").alias("activity")).agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("l_quantity").alias("total_amount"), F.count("part").alias("n_known")
    )


def q09_loss_records(spark, root):
    """D4 alone: the inner join with the loss factors."""
    a = act(spark, root).select("activity", "input_year", "amount")
    led = factors.derive_losses(a, loss_table(spark), B.LOSS_LABELS)
    return _emission_totals(factors.apply_factors(led, resolved(spark), KEEP), ["activity", "input_year", "gpc_ref", "scope"])


def q09_losses(spark, root):
    a = act(spark, root).select("activity", "input_year", "amount")
    led = factors.with_losses(a, loss_table(spark), B.LOSS_LABELS)
    led = factors.apply_factors(led, resolved(spark), KEEP)
    return _emission_totals(led, ["activity", "input_year", "gpc_ref", "scope"])


def q09_loss_gaps(spark, root):
    """Records of a fuel with loss factors, in a year without them: the
    rows the inner loss join drops (semi join, then anti join)."""
    a = act(spark, root).select("activity", "input_year", "amount")
    gaps = factors.loss_coverage_gaps(a, loss_table(spark))
    return gaps.groupBy("activity", "input_year").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("amount").alias("total_amount")
    )


def q10_null_safe(spark, root):
    a = act(spark, root).select(F.expr("nullif(activity, 'SMALL')").alias("activity"), "amount")
    m = literal_table(spark, B.RECODE_NULL_ROWS, B.RECODE_SCHEMA)
    return factors.recode_activity(a, m).groupBy("activity").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("amount").alias("total_amount")
    )


def q11_na_totals(spark, root):
    a = act(spark, root).select("activity", "entity", "input_year", "amount")
    e = factors.apply_factors(a, resolved(spark), KEEP)
    return e.groupBy("entity", "input_year").agg(
        na_sum("total_mtco2e").alias("total_na"),
        sum_or_zero("total_mtco2e").alias("total_ignore_na"),
    )


def act_rollup(spark, root) -> DataFrame:
    """Activity records summed per (year, entity, type, flag): the one
    partial aggregate over the facts that the allocation and the per-year
    totals both derive from."""
    return act(spark, root).groupBy("input_year", "entity", "activity", "supercategory").agg(
        F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n_lines")
    )


def q12_allocation_matrix(spark, root, rollup: DataFrame | None = None):
    a = rollup if rollup is not None else act_rollup(spark, root)
    return allocation.allocation_of_records(
        a.select("input_year", "entity", F.col("activity").alias("waste_type"),
                 F.col("supercategory").alias("disposal_method"), "amount"),
        B.METHOD_COMPOSITIONS, years=B.GRID_YEARS, entities=B.GRID_ENTITIES, types=B.GRID_TYPES,
        supplied_entity=B.SUPPLIED_ENTITY,
    )


def q12_crossing(spark, root):
    """The product of the literal domains, with the records of each cell."""
    grid = crossing(
        spark, "input_year int, entity string, activity string, supercategory string",
        years=B.GRID_YEARS, entities=B.GRID_ENTITIES, types=B.GRID_TYPES, methods=B.GRID_METHODS,
    )
    keys = ["input_year", "entity", "activity", "supercategory"]
    cells = act_rollup(spark, root).select(*keys, "n_lines")
    return lookup_join(grid, cells, keys, "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))


def _composition(rows: DataFrame, kind: str, column: str, pct: str) -> DataFrame:
    """Shares of a (year, entity)'s amounts by ``column``."""
    sums = rows.groupBy("input_year", "entity", F.col(column).alias(kind)).agg(F.sum("amount").alias("__amount"))
    share = F.col("__amount") / F.sum("__amount").over(whole_partition("input_year", "entity"))
    return sums.select("input_year", "entity", kind, share.alias(pct))


def q12_allocation_tables(spark, root):
    """D7 from composition tables, as the full run has it: the same matrix."""
    a = act_rollup(spark, root)
    flag = F.col("supercategory")
    compositions = {
        "total": _composition(a, "waste_type", "activity", "total_waste_pct"),
        "organic": _composition(a.where((flag == "A") & F.col("activity").isin(B.ORGANIC_TYPES)), "organic_waste_subtype", "activity", "organic_waste_pct"),
        "recycling": _composition(a.where(flag == "R"), "waste_type", "activity", "total_recycling_pct"),
    }
    supplied = a.where((F.col("entity") == B.SUPPLIED_ENTITY) & F.col("input_year").isin(B.GRID_YEARS))
    share = F.col("amount") / F.sum("amount").over(whole_partition("input_year", "entity"))
    return allocation.allocation_matrix(
        _composition(a, "disposal_method", "supercategory", "disposal_method_pct"), compositions,
        method_sources={"A": "organic", "N": "total", "R": "recycling"},
        years=B.GRID_YEARS, entities=B.GRID_ENTITIES, types=B.GRID_TYPES, methods=B.GRID_METHODS,
        supplied=supplied.select("input_year", "entity", F.col("activity").alias("waste_type"), flag.alias("disposal_method"), share.alias("percentage")),
    )


def wide_totals(spark, root, rollup: DataFrame | None = None) -> DataFrame:
    """Per-year segment totals as ``<segment>_tonnes`` columns (one
    conditional sum per segment over the shared rollup)."""
    a = rollup if rollup is not None else act_rollup(spark, root)
    cols = [F.sum(F.when(F.col("entity") == s, F.col("amount"))).alias(f"{s}_tonnes")
            for s in B.WIDE_SEGMENTS]
    late = F.sum(
        F.when((F.col("entity") == "MACHINERY") & (F.col("input_year") >= B.LATE_FROM_YEAR),
               F.col("amount"))
    ).alias("late_MACHINERY_tonnes")
    return a.groupBy("input_year").agg(*cols, late, F.sum("n_lines").cast("double").alias("population"))


def q13_entity_totals(spark, root, rollup: DataFrame | None = None):
    w = wide_totals(spark, root, rollup)
    first, last = f"{B.WIDE_SEGMENTS[0]}_tonnes", f"{B.WIDE_SEGMENTS[-1]}_tonnes"
    return allocation.entity_totals(w, ["input_year"], column_range(w, first, last))


def q14_residual(spark, root):
    w = wide_totals(spark, root).withColumns(
        {"per_capita_rate_daily_lbs": F.lit(2.0), "lbs_per_tonne": F.lit(2000.0)}
    )
    out = models.residual_allocation(w, B.RESIDUAL_PARTS, "residual_tonnes")
    return out.select("input_year", "total_annual_tonnes", "residual_tonnes")


def q15_fan_out(spark, root):
    a = act(spark, root).select("activity", "input_year", "amount")
    fan = records.fan_out_activities(a, ["_enteric_fermentation", "_manure"])
    return _emission_totals(factors.apply_factors(fan, resolved(spark), KEEP), ["activity", "input_year"])


def q16_downscale(spark, root):
    # Orders are counted per (customer, year) before meeting the customer
    # and nation dimensions: the join input shrinks to one row per
    # customer-year, and the final count is a sum of partial counts.
    o = read_table(spark, root, "orders", reuse=True).groupBy(
        "o_custkey", F.year("o_orderdate").cast("int").alias("input_year")
    ).agg(F.count(F.lit(1)).alias("n_orders"))
    c = read_table(spark, root, "customer", reuse=True).select("c_custkey", "c_nationkey")
    n = read_table(spark, root, "nation", reuse=True).select("n_nationkey", "n_name")
    oc = lookup_join(o, c, {"o_custkey": "c_custkey"}, "inner")
    ocn = lookup_join(oc, n, {"c_nationkey": "n_nationkey"}, "inner")
    counts = ocn.groupBy("input_year", "n_name").agg(
        F.sum("n_orders").cast("double").alias("headcount")
    )
    a = act(spark, root).select("entity", "input_year", "amount")
    scaling = a.groupBy("input_year").agg(
        F.sum(F.when(F.col("entity") == "BUILDING", F.col("amount"))).alias("local_acreage"),
        F.sum("amount").alias("regional_acreage"),
    )
    out = models.downscale(counts, scaling)
    return out.select("input_year", "n_name", "headcount", "scaling_factor", "local_headcount")


def q17_concentration_load(spark, root):
    """D11 on the records: flows are quantities per (year, segment); the
    effluent concentration is the integer-valued quantity, so its yearly
    mean is exact in any summation order (the influent column, l_discount,
    is averaged too but does not reach the load)."""
    a = act(spark, root).select(
        "input_year", "entity", F.col("amount").alias("wastewater_gallons"),
        F.col("l_discount").alias("influent_bod_mg_l"), F.col("amount").alias("effluent_bod_mg_l"),
    )
    return models.concentration_load_of(a, resolved(spark))


def q17_application_model(spark, root):
    """D14 on the records, in one aggregation: the fertilized share is
    l_linenumber / 8 and the rate the quantity -- dyadic values, so the
    means are exact."""
    yearly = act(spark, root).groupBy("input_year").agg(
        F.sum(F.when(F.col("entity") == "BUILDING", F.col("amount"))).alias("local_acreage"),
        na_mean(F.col("l_linenumber") / F.lit(8.0)).alias("fertilization_pct"),
        na_mean("amount").alias("application_rate"),
    )
    return models.application_rows(yearly, resolved(spark))


def q17_load_tables(spark, root):
    """D11 from two tables, as the full run has it: flows and chemistry."""
    a = act(spark, root)
    flows = a.select("input_year", "entity", F.col("amount").alias("wastewater_gallons"))
    chemistry = a.select("input_year", F.col("l_discount").alias("influent_bod_mg_l"), F.col("amount").alias("effluent_bod_mg_l"))
    return models.concentration_load(flows, chemistry, resolved(spark))


def q17_application_tables(spark, root):
    """D14 from two tables, as the full run has it: areas and practice."""
    a = act(spark, root)
    area = a.groupBy("input_year").agg(F.sum(F.when(F.col("entity") == "BUILDING", F.col("amount"))).alias("local_acreage"))
    practice = a.select("input_year", (F.col("l_linenumber") / F.lit(8.0)).alias("pct_fertilized"), F.col("amount").alias("application_rate_lb_N_acre"))
    return models.application_model(area, practice, resolved(spark))


def _routes(spark, root) -> DataFrame:
    return act(spark, root).select(
        "input_year",
        F.col("amount").alias("miles_per_route"),
        F.col("l_linenumber").cast("double").alias("avg_weekday_trips"),
        (F.col("l_linenumber") / F.lit(2.0)).alias("avg_sat_trips"),
        F.lit(1.0).alias("avg_sun_trips"),
        F.col("l_tax").alias("avg_fuel_efficiency"),
    )


def q18_transit_model(spark, root):
    return models.transit_fuel_model(_routes(spark, root), na_rm=True)


def q18_transit_strict(spark, root):
    """The model's own sum: missing where a route's fuel is missing (l_tax
    is 0 somewhere in every year), known for the late lines kept apart."""
    r = _routes(spark, root)
    both = r.withColumn("service", F.lit("all")).unionByName(
        r.where(F.col("avg_fuel_efficiency") > 0).withColumn("service", F.lit("running"))
    )
    return models.transit_fuel_model(both, by=["input_year", "service"], labels={**K.TRANSIT_FUEL_LABELS})


def q19_labels(spark, root):
    o = read_table(spark, root, "orders", reuse=True).select("o_orderkey", "o_orderpriority", "o_orderstatus")
    o = o.withColumns(
        {
            "priority_label": when_groups("o_orderpriority", B.PRIORITY_GROUPS),
            "status_label": when_map("o_orderstatus", {"F": "filled"}, default=F.col("o_orderstatus")),
            "department": F.col("o_orderpriority"),
        }
    )
    o = records.override_attributes(o, "department", B.DEPARTMENT_RULES)
    return o.select("o_orderkey", "priority_label", "status_label", "department")


def q20_strings(spark, root):
    p = read_table(spark, root, "part", reuse=True)
    return p.select(
        "p_partkey",
        concat_na("p_type", F.when(F.col("p_size") > 25, F.col("p_name")), sep="_").alias("type_name"),
        str_remove_first("p_brand", "Brand#").alias("brand_code"),
        str_remove_first("p_name", "o").alias("name_stub"),
        to_int(str_extract("p_brand", r"\d$")).alias("brand_digit"),
        to_int(str_extract("p_name", r"\d$")).alias("name_digit"),
        F.col("p_size").cast("string").alias("size_text"),
    )


def meter_ledger(spark, root) -> DataFrame:
    ev = read_table(spark, root, "events", reuse=True).select(
        "event_id",
        F.col("ts").alias("usage_end"),
        F.col("event_type").alias("account_fuel"),
        F.col("value").alias("use"),
        F.lit("count").alias("default_units"),
    )
    readings = meters.normalize_meter_readings(
        ev, B.EVENT_FUEL_MAP, years=B.EVENT_YEARS, scaled_fuel=B.EVENT_SCALED_FUEL
    )
    return meters.meter_emissions(readings, loss_table(spark), resolved(spark))


def q21_meter_emissions(spark, root):
    return meter_ledger(spark, root).select(
        "event_id", "year", "activity", "use", "units", "total_co2e_ef", "total_mtco2e"
    )


def q21_meter_stream(spark, root):
    """q21 as a Structured Streaming job: the events table is read as a file
    stream, run through the same operators (stream-static joins to the
    lookups), appended to Parquet under the checkpoint folder with an
    available-now trigger, and read back."""
    from emberledger.streaming.meters import meter_ledger_stream, read_meter_stream, start_meter_ledger

    schema = read_table(spark, root, "events", reuse=True).schema
    ev = read_meter_stream(spark, f"{root.rstrip('/')}/events.parquet", "parquet", schema=schema)
    ev = ev.select(
        "event_id", F.col("ts").alias("usage_end"), F.col("event_type").alias("account_fuel"),
        F.col("value").alias("use"), F.lit("count").alias("default_units"),
    )
    ledger = meter_ledger_stream(
        ev, loss_table(spark), resolved(spark),
        fuel_map=B.EVENT_FUEL_MAP, years=B.EVENT_YEARS, scaled_fuel=B.EVENT_SCALED_FUEL,
    )
    base = scratch_dir(spark, "q21-stream")
    q = start_meter_ledger(ledger, f"{base}/out", f"{base}/checkpoint", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select(
        "event_id", "year", "activity", "use", "units", "total_co2e_ef", "total_mtco2e"
    )


def q22_allocate_and_emit(spark, root):
    rollup = act_rollup(spark, root)
    matrix = q12_allocation_matrix(spark, root, rollup)
    totals = q13_entity_totals(spark, root, rollup)
    return allocation.allocate_and_emit(
        matrix, totals, resolved(spark), method_labels=B.METHOD_LABELS
    )


def q23_regroup(spark, root):
    a = act(spark, root).select("activity", "input_year", "amount")
    g = records.regroup_sum(a, B.DUNG_GROUPS, member="activity", value="amount")
    g = records.fan_out_activities(g, ["", "_indirect"])
    e = factors.apply_factors(g, resolved(spark), KEEP)
    return e.select("input_year", "activity", "amount", "total_co2e_ef", "total_mtco2e")


def inventory_ledger(spark, root) -> DataFrame:
    """Three sectors from one scan of the activity records (the sector is a
    label of the return flag; only stationary energy drops unmatched rows),
    plus orders as a fourth sector without a scope column."""
    f = resolved(spark)
    a = act(spark, root).select(
        when_map("supercategory", B.SECTOR_OF_FLAG).alias("supercategory"),
        F.col("l_linestatus").alias("subcategory"),
        F.concat(F.lit("S."), F.col("supercategory")).alias("gpc_ref"),
        F.when(F.col("supercategory") == "A", 1).when(F.col("supercategory") == "N", 2)
        .otherwise(3).alias("scope"),
        "activity", "entity", "amount", F.lit("units").alias("units"), "input_year",
    )
    a = factors.apply_factors(a, f, KEEP)
    a = a.where(F.col("total_mtco2e").isNotNull() | (F.col("supercategory") != "stationary_energy"))
    o = read_table(spark, root, "orders", reuse=True).select(
        F.lit(B.ORDERS_SECTOR).alias("supercategory"),
        F.lit("orders").alias("subcategory"),
        F.lit("V.9").alias("gpc_ref"),
        F.col("o_orderpriority").alias("activity"),
        F.col("o_orderstatus").alias("entity"),
        F.col("o_totalprice").alias("amount"),
        F.lit("usd").alias("units"),
        F.year("o_orderdate").cast("int").alias("input_year"),
    )
    o = factors.apply_factors(o, f, KEEP)
    return inventory.assemble_inventory(a, o)


def q24_inventory(spark, root):
    return inventory_ledger(spark, root)


def q24_four_sectors(spark, root):
    """Four sector frames with different columns, as the inventory binds
    them: records (all columns), orders (no scope), parts (no subcategory
    and units), meter readings (no entity and gpc_ref)."""
    f = resolved(spark)
    records_ = act(spark, root).where(F.col("supercategory") == "A").select(
        F.lit("stationary_energy").alias("supercategory"), F.col("l_linestatus").alias("subcategory"),
        F.lit("I.1").alias("gpc_ref"), F.lit(1).alias("scope"), "activity", "entity", "amount",
        F.lit("units").alias("units"), "input_year",
    )
    orders = read_table(spark, root, "orders", reuse=True).select(
        F.lit("transportation").alias("supercategory"), F.lit("orders").alias("subcategory"),
        F.lit("II.1").alias("gpc_ref"), F.col("o_orderpriority").alias("activity"),
        F.col("o_orderstatus").alias("entity"), F.col("o_totalprice").alias("amount"),
        F.lit("usd").alias("units"), F.year("o_orderdate").cast("int").alias("input_year"),
    )
    parts = read_table(spark, root, "part", reuse=True).select(
        F.lit("waste").alias("supercategory"), F.lit("III.1").alias("gpc_ref"), F.lit(3).alias("scope"),
        F.col("p_type").alias("activity"), F.col("p_brand").alias("entity"),
        F.col("p_retailprice").alias("amount"), (F.lit(1995) + F.col("p_size") % 6).cast("int").alias("input_year"),
    )
    events = read_table(spark, root, "events", reuse=True).select(
        F.lit(B.ORDERS_SECTOR).alias("supercategory"), F.lit("events").alias("subcategory"),
        F.lit(1).alias("scope"), F.col("event_type").alias("activity"), F.col("value").alias("amount"),
        F.lit("count").alias("units"), F.year("ts").cast("int").alias("input_year"),
    )
    frames = [factors.apply_factors(x, f, p) for x, p in ((records_, DROP), (orders, KEEP), (parts, KEEP), (events, KEEP))]
    led = inventory.assemble_inventory(*frames)
    keys = [c for c in led.columns if c not in ("amount", "total_mtco2e")]
    return led.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_records"), sum_or_zero(F.col("amount").cast("decimal(38,4)")).alias("amount"),
        F.count_if(F.col("total_mtco2e").isNull()).alias("n_unmatched"),
    )


def _building(spark, root) -> DataFrame:
    return inventory_ledger(spark, root).where(F.col("entity") == "BUILDING")


def q25_annual_totals(spark, root):
    led = _building(spark, root).where(F.col("supercategory") == "Stationary Energy")
    return report.annual_totals(led, ["input_year"], out="total_mtco2e")


def q26_baseline_vs_current(spark, root):
    """One entity's whole ledger: unmatched records make the baseline
    missing, and with it the change."""
    return report.baseline_vs_current(_building(spark, root), 1995, 2000)


def q26_baseline_known(spark, root):
    """The sector without unmatched records: the baseline is known."""
    led = _building(spark, root).where(F.col("supercategory") == "Stationary Energy")
    return report.baseline_vs_current(led, 1995, 2000)


def q27_change_vs_baseline(spark, root):
    return report.change_vs_baseline(inventory_ledger(spark, root), by=["entity"])


def q27_change_overall(spark, root):
    """Against the first year of one entity's ledger, without groups."""
    return report.change_vs_baseline(_building(spark, root))


def q27_change_fitted(spark, root):
    """Labels with as many decimals as each entity's column needs."""
    return report.change_vs_baseline(inventory_ledger(spark, root), by=["entity"], decimals=None)


def stored_state(spark, root) -> DataFrame:
    """The ledger's state as a run would leave it: all years stored once, and
    one year stored wrong before it was run again."""
    led = inventory_ledger(spark, root)
    path = scratch_dir(spark, "state")
    wrong = F.when(F.col("input_year") == 1997, F.col("total_mtco2e") * 2 + 1).otherwise(F.col("total_mtco2e"))
    report_state.store_state(report_state.ledger_state(led.withColumn("total_mtco2e", wrong)), path)
    report_state.store_state(report_state.ledger_state(led.where(F.col("input_year") == 1997)), path)
    return report_state.read_state(spark, path)


def q27_change_from_state(spark, root):
    """q27 from stored partial aggregates, after one year was run again."""
    return report_state.change_vs_baseline(stored_state(spark, root), by=["entity"])


def q28_share_from_state(spark, root):
    """q28 from stored partial aggregates, after one year was run again."""
    return report_state.sector_share(stored_state(spark, root))


def q28_sector_share(spark, root):
    """The whole ledger: a sector with an unmatched record has no total, and
    its year no shares."""
    return report.sector_share(inventory_ledger(spark, root))


def q28_sector_share_known(spark, root):
    led = inventory_ledger(spark, root).where(F.col("total_mtco2e").isNotNull())
    return report.sector_share(led)


def _fuel_mix(led: DataFrame) -> DataFrame:
    led = led.withColumn("day", F.to_date("usage_end").cast("string"))
    return report.fuel_mix(led, period="day")


def q29_fuel_mix(spark, root):
    """All readings: a fuel without factors has no total, its day no shares."""
    return _fuel_mix(meter_ledger(spark, root))


def q29_fuel_mix_known(spark, root):
    return _fuel_mix(meter_ledger(spark, root).where(F.col("total_mtco2e").isNotNull()))


QUERIES: dict[str, Query] = {
    "q01_resolve_factors": q01_resolve_factors,
    "q01_workbook_sheets": q01_workbook_sheets,
    "q02_csv_roundtrip": q02_csv_roundtrip,
    "q02_reject_channel": q02_reject_channel,
    "q02_published": q02_published,
    "q03_literal_domain": q03_literal_domain,
    "q04_projection": q04_projection,
    "q05_household_model": q05_household_model,
    "q06_filters": q06_filters,
    "q06_membership": q06_membership,
    "q07_recode": q07_recode,
    "q08_emissions": q08_emissions,
    "q08_matched_only": q08_matched_only,
    "q08_hot_keys": q08_hot_keys,
    "q09_loss_records": q09_loss_records,
    "q09_losses": q09_losses,
    "q09_loss_gaps": q09_loss_gaps,
    "q10_null_safe": q10_null_safe,
    "q11_na_totals": q11_na_totals,
    "q12_allocation_matrix": q12_allocation_matrix,
    "q12_crossing": q12_crossing,
    "q12_allocation_tables": q12_allocation_tables,
    "q13_entity_totals": q13_entity_totals,
    "q14_residual": q14_residual,
    "q15_fan_out": q15_fan_out,
    "q16_downscale": q16_downscale,
    "q17_concentration_load": q17_concentration_load,
    "q17_application_model": q17_application_model,
    "q17_load_tables": q17_load_tables,
    "q17_application_tables": q17_application_tables,
    "q18_transit_model": q18_transit_model,
    "q18_transit_strict": q18_transit_strict,
    "q19_labels": q19_labels,
    "q20_strings": q20_strings,
    "q21_meter_emissions": q21_meter_emissions,
    "q21_meter_stream": q21_meter_stream,
    "q22_allocate_and_emit": q22_allocate_and_emit,
    "q23_regroup": q23_regroup,
    "q24_inventory": q24_inventory,
    "q24_four_sectors": q24_four_sectors,
    "q25_annual_totals": q25_annual_totals,
    "q26_baseline_vs_current": q26_baseline_vs_current,
    "q26_baseline_known": q26_baseline_known,
    "q27_change_vs_baseline": q27_change_vs_baseline,
    "q27_change_overall": q27_change_overall,
    "q27_change_fitted": q27_change_fitted,
    "q27_change_from_state": q27_change_from_state,
    "q28_share_from_state": q28_share_from_state,
    "q28_sector_share": q28_sector_share,
    "q28_sector_share_known": q28_sector_share_known,
    "q29_fuel_mix": q29_fuel_mix,
    "q29_fuel_mix_known": q29_fuel_mix_known,
}
