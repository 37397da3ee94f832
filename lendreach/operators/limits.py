"""Rate card, next loan limits, state caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.operators.joins import lookup_one
from lendreach.operators.ranking import current_version

MAX_SEQUENCE = 7


def rate_product(state: Column, product: Column, store: Column,
                 remap: Sequence[tuple[str, str, str, str]]) -> Column:
    """Product code on the rate card: (state, product, store text) rows map to a variant."""
    out = None
    for s, p, text, variant in remap:
        cond = (state == s) & (product == p) & F.contains(store, F.lit(text))
        out = F.when(cond, variant) if out is None else out.when(cond, variant)
    return product if out is None else out.otherwise(product)


def _capped(sequence: Column, cap: int | None) -> Column:
    if cap is None:
        return sequence
    return F.when(sequence.isNotNull(), F.least(sequence, F.lit(cap)))


def rate_card_join(df: DataFrame, rates: DataFrame, frequency: Column, step: int = 0,
                   remap: Sequence[tuple[str, str, str, str]] = (), cap: int | None = MAX_SEQUENCE,
                   remap_where: Column | None = None) -> DataFrame:
    """Left join on state, product variant, capped loan sequence and pay frequency.

    ``remap_where`` limits the variants to some rows; the others keep their product. A null sequence
    has no rate; ``cap`` None leaves sequences as they are.
    """
    r = rates.select(F.col("state_code").alias("_state"), F.col("product_code").alias("_product"),
                     F.col("loan_sequence").alias("_seq"), F.col("pay_frequency").alias("_freq"),
                     "rpp", "hardcap", "min_amt")
    variant = rate_product(F.col("state"), F.col("product"), F.col("storename"), remap)
    if remap_where is not None:
        variant = F.when(remap_where, variant).otherwise(F.col("product"))
    left = (df.withColumn("_p", variant)
            .withColumn("_s", _capped(F.col("loan_sequence") + step, cap))
            .withColumn("_f", frequency))
    cond = ((F.col("state") == F.col("_state")) & (F.col("_p") == F.col("_product"))
            & (F.col("_s") == F.col("_seq")) & (F.col("_f") == F.col("_freq")))
    return (left.join(r, cond, "left").withColumnRenamed("_p", "rate_product")
            .drop("_state", "_product", "_seq", "_freq", "_s", "_f"))


def entity_state(name: Column, long_names: Sequence[tuple[str, str]],
                 stateless: Sequence[str]) -> Column:
    """State of a legal entity by its name: listed names first, else the first two letters."""
    out = None
    for text, state in long_names:
        cond = F.contains(name, F.lit(text))
        out = F.when(cond, state) if out is None else out.when(cond, state)
    for text in stateless:
        cond = F.contains(name, F.lit(text))
        out = F.when(cond, None) if out is None else out.when(cond, None)
    first = F.left(name, F.lit(2))
    return first if out is None else out.otherwise(first)


def limit_by_state(limits: DataFrame, params: DataFrame, long_names: Sequence[tuple[str, str]],
                   stateless: Sequence[str]) -> DataFrame:
    """Highest current limit per state: entity name to state, latest date per entity and pay
    frequency, then the largest."""
    names = (params.filter("parameter_name = 'entity_name'")
             .select(F.col("lms_entity_id").alias("entity_id"), F.col("value").alias("entity_name")))
    named = lookup_one(limits, names, ["entity_id"], "entity_name", [F.col("entity_name")])
    current = current_version(named, ["entity_id", "pay_frequency"], "effective_date")
    return (current.withColumn("state", entity_state(F.col("entity_name"), long_names, stateless))
            .groupBy("state").agg(F.max("maximum_limit").alias("maximum_limit_by_state")))


def entity_state_mismatch(headers: DataFrame, long_names: Sequence[tuple[str, str]],
                          stateless: Sequence[str]) -> DataFrame:
    """Rows whose recorded state differs from the one in the entity name."""
    skip = F.lit(False)
    for text in stateless:
        skip = skip | F.contains(F.col("entity_name"), F.lit(text))
    derived = entity_state(F.col("entity_name"), long_names, ())
    return (headers.filter(F.col("entity_name").isNotNull() & ~skip)
            .withColumn("entity_state", derived)
            .filter("not (entity_state <=> state)"))
