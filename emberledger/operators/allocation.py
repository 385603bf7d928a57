"""Allocation and downscaling of totals: allocation matrix (D7), entity
totals from a wide table (D9) and allocate-and-emit (D10).

The model defines the matrix as the product of four value domains (year x
entity x type x method) left-joined to four composition tables, keeping
rows whose share is known.  A grid row survives only when its method
composition and the composition chosen for that method both match, so
the same rows come from an equi-join of the method composition with the
chosen type composition on (year, entity), restricted to the domains.
No grid, and no cross join, is ever materialized.  Compositions are
assumed unique on their keys (as dimension tables are).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberledger import constants as K
from emberledger.functions.semantics import na_sum, str_extract, str_remove_first, to_int, whole_partition
from emberledger.operators.factors import KEEP, apply_factors
from emberledger.operators.relational import bind, lookup_join, to_long, when_map
from emberledger.sources.schemas import SECTOR_COLUMNS

GRID_COLUMNS = ["input_year", "entity", "waste_type", "disposal_method", "percentage"]


def _in_domain(df: DataFrame, column: str, domain: Sequence | None) -> DataFrame:
    return df if domain is None else df.where(F.col(column).isin(list(domain)))


def allocation_matrix(
    method_composition: DataFrame,
    type_compositions: Mapping[str, DataFrame],
    method_sources: Mapping[str, str] = K.METHOD_SOURCES,
    years: Sequence[int] | None = K.WASTE_YEARS,
    entities: Sequence[str] | None = None,
    types: Sequence[str] | None = K.WASTE_TYPES,
    methods: Sequence[str] | None = K.DISPOSAL_METHODS,
    supplied: DataFrame | None = None,
) -> DataFrame:
    """Share of an entity's total for each (year, entity, type, method).

    ``method_composition``: (input_year, entity, disposal_method,
    disposal_method_pct).  ``type_compositions``: name -> (input_year,
    entity, waste_type, pct) -- the pct column may have any name; the last
    column is used.  ``method_sources`` picks the composition for each
    method; a method without one gets no rows (its share is null).
    ``supplied`` rows, already in grid form, are appended; rows with a
    share <= 0 or null are dropped.  A domain of ``None`` means all values.
    """
    typed = []
    for name, comp in type_compositions.items():
        year_c, entity_c, type_c, pct_c = comp.columns[:3] + comp.columns[-1:]
        part = comp.select(
            F.col(year_c).alias("input_year"),
            F.col(entity_c).alias("entity"),
            F.col(type_c).alias("waste_type"),
            F.lit(name).alias("__source"),
            F.col(pct_c).cast("double").alias("__type_pct"),
        )
        part = _in_domain(_in_domain(part, "waste_type", types), "input_year", years)
        typed.append(_in_domain(part, "entity", entities))
    by_type = bind(*typed)
    by_method = method_composition.select(
        "input_year", "entity", "disposal_method",
        F.col("disposal_method_pct").cast("double"),
        when_map("disposal_method", method_sources).alias("__source"),
    )
    by_method = _in_domain(by_method, "disposal_method", methods)
    by_method = _in_domain(_in_domain(by_method, "input_year", years), "entity", entities)
    keys = ["input_year", "entity", "__source"]
    grid = lookup_join(by_method, by_type, keys, "inner").select(
        "input_year", "entity", F.col("waste_type"), "disposal_method",
        (F.col("__type_pct") * F.col("disposal_method_pct")).alias("percentage"),
    ).where(F.col("percentage").isNotNull())
    if supplied is not None:
        # union by name: a column the supplied table lacks is null
        have = set(supplied.columns)
        grid = bind(grid, supplied.select(*[c for c in GRID_COLUMNS if c in have]))
    return grid.where(F.col("percentage") > 0)


def allocation_of_records(
    rollup: DataFrame,
    method_sources: Mapping[str, Mapping[str, object]],
    years: Sequence[int],
    entities: Sequence[str],
    types: Sequence[str],
    supplied_entity: str,
) -> DataFrame:
    """The matrix (D7) where all compositions come from the same records.

    ``rollup``: (input_year, entity, waste_type, disposal_method, amount),
    one row per key.  ``method_sources``: method -> ``{"of": method whose
    amounts make up the type composition, or None for all; "types": the
    types it has, or None}``.  One window over (year, entity) gives every
    total; the shares are quotients of a row's amounts by them.  The rows of
    ``supplied_entity`` are its shares by type and method.
    """
    methods = list(method_sources)
    amount = F.col("amount")

    def of(method: str | None) -> Column:
        return amount if method is None else F.when(F.col("disposal_method") == method, amount)

    pieces = {"all": None, **{m: m for m in methods}}
    typed = rollup.where(F.col("input_year").isin(list(years))).groupBy("input_year", "entity", "waste_type").agg(
        *[F.sum(of(m)).alias(f"__{n}") for n, m in pieces.items()]
    )
    whole = whole_partition("input_year", "entity")
    totals = {f"__t_{n}": F.sum(f"__{n}").over(whole) for n in pieces}
    for m, source in method_sources.items():
        own = F.col("waste_type").isin(list(source["types"])) if source["types"] is not None else F.lit(True)
        totals[f"__c_{m}"] = F.sum(F.when(own, F.col(f"__{source['of'] or 'all'}"))).over(whole)
    typed = typed.withColumns(totals)
    is_supplied = F.col("entity") == supplied_entity
    in_grid = F.col("entity").isin(list(entities)) & F.col("waste_type").isin(list(types))
    shares = []
    for m, source in method_sources.items():
        own = F.col("waste_type").isin(list(source["types"])) if source["types"] is not None else F.lit(True)
        composition = F.when(own, F.col(f"__{source['of'] or 'all'}")) / F.col(f"__c_{m}")
        share = F.when(in_grid, composition * (F.col(f"__t_{m}") / F.col("__t_all")))
        share = F.when(is_supplied, F.col(f"__{m}") / F.col("__t_all")).otherwise(share)
        shares.append(F.struct(F.lit(m).alias("disposal_method"), share.alias("percentage")))
    out = typed.select("input_year", "entity", "waste_type", F.explode(F.array(*shares)).alias("__m"))
    return out.select("input_year", "entity", "waste_type", "__m.*").where(F.col("percentage") > 0)


def entity_totals(
    wide: DataFrame,
    ids: Sequence[str] = ("input_year",),
    values: Sequence[str] | None = None,
    suffix: str = K.ENTITY_TONNES_SUFFIX,
    names_to: str = "entity",
    values_to: str = "total_tonnes",
) -> DataFrame:
    """One row per (year, entity) from ``<entity>_tonnes`` columns.

    Null cells are kept; the first ``suffix`` match is removed from the
    column name.
    """
    values = list(values) if values is not None else [c for c in wide.columns if c not in ids]
    long = to_long(wide.select(*ids, *values), ids, values, names_to, values_to)
    return long.withColumn(names_to, str_remove_first(names_to, suffix))


def allocate_and_emit(
    matrix: DataFrame,
    totals: DataFrame,
    factors: DataFrame,
    method_labels: Mapping[str, Mapping[str, str]] = K.METHOD_LABELS,
    supercategory: str = K.SUPERCATEGORY_WASTE,
    units: str = K.SOLID_WASTE_UNITS,
) -> DataFrame:
    """share x entity total, summed over types per method, labelled and
    turned into emissions (D10).

    ``scope`` is the trailing digit of ``gpc_ref``.  Methods without labels
    (recycling) keep null labels; unmatched factors stay null (keep policy).
    The summed amounts are exact: the same in any partitioning.
    """
    joined = lookup_join(
        matrix, totals.select("input_year", "entity", "total_tonnes"),
        ["input_year", "entity"], "left", null_safe=True,
    )
    tonnes = joined.groupBy("input_year", "entity", "disposal_method").agg(
        na_sum(F.col("percentage") * F.col("total_tonnes"), exact=True).alias("amount")
    )
    labelled = tonnes.withColumns(
        {
            "supercategory": F.lit(supercategory),
            "subcategory": when_map(
                "disposal_method", {m: v["subcategory"] for m, v in method_labels.items()}
            ),
            "gpc_ref": when_map(
                "disposal_method", {m: v["gpc_ref"] for m, v in method_labels.items()}
            ),
            "units": F.lit(units),
        }
    )
    labelled = labelled.withColumn("scope", to_int(str_extract("gpc_ref", r"\d$")))
    labelled = labelled.withColumnRenamed("disposal_method", "activity")
    out = apply_factors(labelled, factors, KEEP)
    return out.select(*SECTOR_COLUMNS)
