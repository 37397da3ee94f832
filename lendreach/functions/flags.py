"""Predicates and 0/1 flags, row-wise and inside aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def one(cond: Column) -> Column:
    """1 when true, else 0 (also for null)."""
    return F.when(cond, 1).otherwise(0)


def flag_any(cond: Column) -> Column:
    """Aggregate: did any row of the group match?"""
    return F.max(one(cond))


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def sum_where(cond: Column, value: Column) -> Column:
    """Sum of ``value`` over matching rows, 0 when none matches."""
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0))


def cond_agg(specs: Mapping[str, tuple[str, Column, Column | None]]) -> list[Column]:
    """Manual pivot: name -> (count | sum | max | min, condition, value)."""
    out = []
    for name, (kind, cond, value) in specs.items():
        if kind == "count":
            agg = count_where(cond)
        elif kind == "sum":
            agg = sum_where(cond, value)
        else:
            agg = getattr(F, kind)(F.when(cond, value))
        out.append(agg.alias(name))
    return out


def count_distinct_if(cond: Column, c: Column) -> Column:
    return F.count_distinct(F.when(cond, c))


def optin_filter(c: Column, opted_in_only: bool) -> Column:
    """Opted in only, or either known answer; unknown answers are dropped both ways."""
    return c.isin(1) if opted_in_only else c.isin(0, 1)


def not_test(c: Column) -> Column:
    return c == 0


def carve_out(state: Column, product: Column, pairs: Sequence[tuple[Sequence[str], Sequence[str]]]) -> Column:
    """False for rows in any (states, products) pair; null-safe, so unknown values stay in."""
    hit = F.lit(False)
    for states, products in pairs:
        hit = hit | F.coalesce(state.isin(list(states)) & product.isin(list(products)), F.lit(False))
    return ~hit


def eligibility(rules: Mapping[str, object]) -> Column:
    """All rules at once: a list is a whitelist, ``("not", list)`` a blacklist,
    ``("between", lo, hi)`` a range, anything else an equality."""
    keep = F.lit(True)
    for name, rule in rules.items():
        c = F.col(name)
        if isinstance(rule, list):
            keep = keep & c.isin(rule)
        elif isinstance(rule, tuple) and rule[0] == "not":
            keep = keep & ~c.isin(list(rule[1]))
        elif isinstance(rule, tuple) and rule[0] == "between":
            keep = keep & c.between(rule[1], rule[2])
        else:
            keep = keep & (c == rule)
    return keep


def usable_phone(cell: Column, home: Column, placeholders: Sequence[str]) -> Column:
    """Cell number unless it is missing, blank or a placeholder; then the home number."""
    bad = cell.isNull() | (F.trim(cell) == "") | cell.isin(list(placeholders))
    return F.when(bad, home).otherwise(cell)


def wait_group(state: Column, product: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """``STATE_PRODUCT`` for the listed pairs, OTHERS for the rest."""
    out = None
    for s, p in pairs:
        cond = (state == s) & (product == p)
        out = F.when(cond, f"{s}_{p}") if out is None else out.when(cond, f"{s}_{p}")
    return F.lit("OTHERS") if out is None else out.otherwise("OTHERS")


def reject_reason(decision: Column, detail: Column) -> Column:
    return F.when(F.lower(decision) == "reject",
                  F.when(detail == "Internal Underwriting", "Internal_U/W")
                  .when(detail.like("%Schema%"), "Schema Reject")
                  .when(detail == "Duplicate Customer", "Dedup Reject")
                  .otherwise("Others"))


def rule_label(decision: Column, inquiry_action: Column, reject: Column, business_rule: Column,
               rule_text: Column, detail: Column) -> Column:
    rejected = F.lower(decision) == "reject"
    return (F.when(rejected & (inquiry_action == "Deny"), "Clear Inquiry Reject")
            .when(rejected & (reject == "Internal Underwriting"),
                  F.concat(F.lit("IU: "), business_rule))
            .when(rejected & (reject != "Internal Underwriting"), reject)
            .when(F.lower(decision) == "accept", rule_text)
            .otherwise(detail))
