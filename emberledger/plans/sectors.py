"""Sector ledgers and the full inventory from landed input tables.

``tables`` maps the names in ``sources.schemas.TABLES`` to DataFrames
(load them once with ``sources.io.load_tables`` and share them).  Factors
are resolved once per call of ``inventory`` and broadcast to every sector.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberledger import constants as K
from emberledger.operators import allocation, factors, inventory as inv, meters, models, records
from emberledger.operators.factors import DROP, KEEP
from emberledger.operators.relational import bind
from emberledger.sources.schemas import SECTOR_COLUMNS

Tables = Mapping[str, DataFrame]


def resolved_factors(t: Tables) -> DataFrame:
    return factors.resolve_factors(t["activity_emissions_key"], t["emissions_factors"])


def _sector(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in SECTOR_COLUMNS if c in df.columns])


def stationary_ledger(
    t: Tables, ef: DataFrame | None = None, loss_labels=K.LOSS_LABELS
) -> DataFrame:
    """Recoded stationary records, their transmission/distribution losses
    and the household heating model; rows without a total are dropped."""
    ef = ef if ef is not None else resolved_factors(t)
    clean = factors.recode_activity(t["stationary_inputs"], t["activity_map"])
    records = factors.with_losses(_sector(clean), t["transmission_loss_factors"], loss_labels)
    heating = models.household_fuel_model(t["res_heat_oil_model_inputs"])
    return factors.apply_factors(bind(records, heating), ef, DROP)


def transportation_ledger(t: Tables, ef: DataFrame | None = None, **transit) -> DataFrame:
    """Recoded transportation records plus the transit fuel model; rows
    without a factor are kept with null totals."""
    ef = ef if ef is not None else resolved_factors(t)
    clean = factors.recode_activity(t["transportation_inputs"], t["activity_map"])
    transit_rows = models.transit_fuel_model(t["transit_model_inputs"], **transit)
    return factors.apply_factors(bind(_sector(clean), transit_rows), ef, KEEP)


def waste_ledger(
    t: Tables,
    entities: Sequence[str],
    named_parts: Sequence[str],
    residual_entity: str,
    ef: DataFrame | None = None,
    years: Sequence[int] | None = K.WASTE_YEARS,
) -> DataFrame:
    """Solid waste allocated by entity, type and disposal method, plus the
    wastewater load.

    ``entities`` is the entity domain of the allocation grid;
    ``solid_waste_inputs`` carries one ``<entity>_tonnes`` column per
    entity in ``named_parts`` and the residual entity's tonnes are the
    modelled total minus those parts.
    """
    ef = ef if ef is not None else resolved_factors(t)
    comp = {
        "total": t["solid_waste_composition"].select(
            "input_year", "entity", "waste_type", "total_waste_pct"),
        "organic": t["organic_waste_composition"].select(
            "input_year", "entity", "organic_waste_subtype", "organic_waste_pct"),
        "recycling": t["recycling_composition"].select(
            "input_year", "entity", "waste_type", "total_recycling_pct"),
    }
    matrix = allocation.allocation_matrix(
        t["waste_method_composition"], comp, entities=entities, years=years,
        supplied=t.get("supplied_disposal_methods"),
    )
    suffix = K.ENTITY_TONNES_SUFFIX
    residual = f"{residual_entity}{suffix}"
    parts = [f"{e}{suffix}" for e in named_parts]
    wide = models.residual_allocation(t["solid_waste_inputs"], parts, residual)
    totals = allocation.entity_totals(wide, ["input_year"], [residual, *parts])
    solid = allocation.allocate_and_emit(matrix, totals, ef)
    water = models.concentration_load(t["wastewater_inputs"], t["wastewater_chemicals"], ef)
    return bind(solid, water)


def agriculture_ledger(t: Tables, ef: DataFrame | None = None) -> DataFrame:
    """Livestock (enteric fermentation and manure per animal), fertilizer
    application and dung groups, direct and indirect."""
    ef = ef if ef is not None else resolved_factors(t)
    heads = models.downscale(t["regional_livestock"], t["acreage_scaling"])
    animals = heads.select(
        "input_year", F.col("animal").alias("activity"), F.col("local_headcount").alias("amount")
    )
    livestock = models.with_labels(
        records.fan_out_activities(animals, K.LIVESTOCK_PROCESS_SUFFIXES), K.LIVESTOCK_LABELS
    )
    livestock = factors.apply_factors(livestock, ef, KEEP)
    fertilizer = models.application_model(t["acreage_scaling"], t["fertilization_pcts"], ef)
    dung = records.regroup_sum(heads, K.DUNG_GROUPS, member="animal", value="local_headcount")
    dung = models.with_labels(records.fan_out_activities(dung, K.DIRECT_AND_INDIRECT), K.DUNG_LABELS)
    dung = factors.apply_factors(dung, ef, KEEP)
    return bind(_sector(livestock), fertilizer, _sector(dung))


def meter_ledger(
    export: DataFrame,
    t: Tables,
    department_rules: Sequence[tuple[str, Sequence[object], object]] = (),
    ef: DataFrame | None = None,
    **normalize,
) -> DataFrame:
    """Account-level ledger: normalized readings, direct and loss
    emissions, fiscal-year label and department overrides."""
    ef = ef if ef is not None else resolved_factors(t)
    readings = meters.normalize_meter_readings(export, **normalize)
    out = meters.meter_emissions(readings, t["transmission_loss_factors"], ef)
    out = out.withColumn("fiscal_year", inv.fiscal_year_label("year"))
    return records.override_attributes(out, "department", department_rules)


def inventory(
    t: Tables,
    waste_entities: Sequence[str],
    waste_named_parts: Sequence[str],
    waste_residual_entity: str,
    waste_years: Sequence[int] | None = K.WASTE_YEARS,
    ef: DataFrame | None = None,
    transit: Mapping[str, object] | None = None,
) -> DataFrame:
    """The four sector ledgers under one schema with fiscal-year labels;
    factors are resolved once and shared by all sectors.  ``transit`` are
    arguments of the transit model, such as ``labels`` with the activity
    name that the key table uses."""
    ef = ef if ef is not None else resolved_factors(t)
    return inv.assemble_inventory(
        stationary_ledger(t, ef),
        waste_ledger(t, waste_entities, waste_named_parts, waste_residual_entity, ef, waste_years),
        transportation_ledger(t, ef, **(transit or {})),
        agriculture_ledger(t, ef),
    )
