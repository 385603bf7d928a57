"""Factor operators: recode activities (D1), resolve factors (D2), apply
factors (D3) and derive transmission/distribution losses (D4).

Facts may be billions of rows; every lookup here is a dimension that is
broadcast when it is small (see ``relational.fits_broadcast``), so
applying factors is a map-only stage with no shuffle of the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberledger.functions.semantics import concat_na
from emberledger.operators.relational import carry_bound, lookup_join, when_map

KEEP = "keep"
DROP = "drop"


def recode_activity(
    records: DataFrame,
    activity_map: DataFrame,
    column: str = "activity",
    raw: str = "activity",
    recoded: str = "activity_recoded",
) -> DataFrame:
    """Replace raw activity names by canonical ones.

    A left join: records whose name is not in the map are kept with a null
    activity.  A null name matches a null map entry (dplyr semantics).
    """
    lookup = carry_bound(
        activity_map, activity_map.select(F.col(raw).alias("__raw"), F.col(recoded).alias("__recoded"))
    )
    out = lookup_join(records, lookup, {column: "__raw"}, "left", null_safe=True)
    return out.withColumn(column, F.col("__recoded")).drop("__recoded")


def resolve_factors(
    key: DataFrame,
    factors: DataFrame,
    activity: str = "activity",
    year: str = "input_year",
    factor_id: str = "emissions_factor",
    value: str = "total_co2e_ef",
) -> DataFrame:
    """(activity, year) -> factor value, through the factor id.

    Both inputs are small dimensions; the result is resolved once and then
    shared by every sector.  A key whose factor id is unknown (or null,
    without a null id in ``factors``) gets a null value.
    """
    ids = carry_bound(factors, factors.select(F.col(factor_id).alias("__fid"), F.col(value)))
    out = lookup_join(key, ids, {factor_id: "__fid"}, "left", null_safe=True)
    return carry_bound(out, out.select(activity, year, value))


def apply_factors(
    records: DataFrame,
    factors: DataFrame,
    policy: str = KEEP,
    amount: str = "amount",
    on: Sequence[str] | Mapping[str, str] = ("activity", "input_year"),
    value: str = "total_co2e_ef",
    out: str = "total_mtco2e",
) -> DataFrame:
    """emissions = amount x factor (D3).

    ``policy='keep'`` keeps unmatched records with null factor and total;
    ``policy='drop'`` removes records whose total is null (then Catalyst
    turns the outer join into an inner one).  ``factors`` must be unique on
    its keys, or matched records are multiplied.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    lookup = carry_bound(factors, factors.select(*[F.col(d) for d in pairs.values()], F.col(value)))
    joined = lookup_join(records, lookup, pairs, "left", null_safe=True)
    joined = joined.withColumn(out, F.col(amount) * F.col(value))
    if policy == DROP:
        return joined.where(F.col(out).isNotNull())
    if policy != KEEP:
        raise ValueError(f"unknown unmatched-row policy: {policy!r}")
    return joined


def derive_losses(
    records: DataFrame,
    loss_factors: DataFrame,
    labels: Mapping[str, Mapping[str, object]] | None = None,
    fuel: str = "activity",
    year: str = "input_year",
    amount: str = "amount",
    keep_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Loss records from fuel records.

    Each record meets every loss row for its (fuel, year) -- an inner join,
    so records without a loss factor that year yield nothing, and a fuel
    with two loss types yields two rows.  The loss amount is
    ``amount * loss_factor`` and the activity becomes ``<fuel>_<type>``.
    ``labels`` maps a fuel to replacement column values (e.g. ``gpc_ref``,
    ``scope``); fuels without a label get nulls there (N5).
    """
    loss = carry_bound(loss_factors, loss_factors.select("fuel_type", "type", "loss_factor", "input_year"))
    joined = lookup_join(
        records, loss, {fuel: "fuel_type", year: "input_year"}, "inner", null_safe=True
    )
    joined = joined.withColumn(amount, F.col(amount) * F.col("loss_factor"))
    replaced: dict[str, object] = {}
    for column in sorted({c for v in (labels or {}).values() for c in v}):
        replaced[column] = when_map(fuel, {f: v.get(column) for f, v in labels.items()})
    joined = joined.withColumns(replaced) if replaced else joined
    joined = joined.withColumn(fuel, concat_na(fuel, "type", sep="_"))
    out = joined.drop("loss_factor", "type")
    if keep_columns is not None:
        out = out.select(*keep_columns)
    return out


def with_losses(
    records: DataFrame,
    loss_factors: DataFrame,
    labels: Mapping[str, Mapping[str, object]] | None = None,
    fuel: str = "activity",
    year: str = "input_year",
    amount: str = "amount",
) -> DataFrame:
    """Every record plus its loss records (D4 and the union that follows
    it), in one pass over ``records``.

    Loss types are gathered per (fuel, year) into a small lookup (bounded
    by the loss table) and broadcast-joined; each record then explodes into
    itself and one row per loss type.  Same rows as ``bind(records,
    derive_losses(records, ...))`` without reading the records twice.
    Columns replaced by ``labels`` keep their value on direct rows; a
    labelled column the records lack is null there.
    """
    per_key = carry_bound(
        loss_factors,
        loss_factors.groupBy(F.col("fuel_type"), F.col("input_year")).agg(
            F.collect_list(F.struct(F.lit(True).alias("is_loss"), "type", "loss_factor")).alias("__losses")
        ),
    )
    joined = lookup_join(
        records, per_key, {fuel: "fuel_type", year: "input_year"}, "left", null_safe=True, sized_as=loss_factors
    )
    direct = F.array(F.struct(
        F.lit(False).alias("is_loss"), F.lit(None).cast("string").alias("type"),
        F.lit(None).cast("double").alias("loss_factor"),
    ))
    rows = F.when(F.col("__losses").isNull(), direct).otherwise(F.concat(direct, F.col("__losses")))
    out = joined.withColumn("__l", F.explode(rows)).drop("__losses")
    is_loss = F.col("__l.is_loss")
    replaced: dict[str, object] = {
        amount: F.when(is_loss, F.col(amount) * F.col("__l.loss_factor")).otherwise(F.col(amount)),
        fuel: F.when(is_loss, concat_na(F.col(fuel), F.col("__l.type"), sep="_")).otherwise(F.col(fuel)),
    }
    for column in sorted({c for v in (labels or {}).values() for c in v}):
        label = when_map(fuel, {f: v.get(column) for f, v in labels.items()})
        keep = F.col(column) if column in records.columns else F.lit(None)
        replaced[column] = F.when(is_loss, label).otherwise(keep)
    return out.withColumns(replaced).drop("__l")


def loss_coverage_gaps(
    records: DataFrame,
    loss_factors: DataFrame,
    fuel: str = "activity",
    year: str = "input_year",
) -> DataFrame:
    """Records of a fuel that has loss factors in some year but not in the
    record's year -- the rows ``derive_losses`` silently drops."""
    fuels = carry_bound(loss_factors, loss_factors.select(F.col("fuel_type").alias("__f")).distinct())
    years = carry_bound(loss_factors, loss_factors.select("fuel_type", "input_year").distinct())
    lossy = lookup_join(records, fuels, {fuel: "__f"}, "left_semi")
    return lookup_join(lossy, years, {fuel: "fuel_type", year: "input_year"}, "left_anti")


def duplicate_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a lookup, with their count.

    ``apply_factors`` multiplies records on such keys, so a non-empty result
    means the lookup must be fixed first.  A grouped count with partial
    aggregation, so it scales with the lookup.
    """
    return (
        dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )
