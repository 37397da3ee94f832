"""Text: names, mail addresses, keys, codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mail endings accepted as deliverable.
MAIL_ENDINGS = ("com", "ca", "net", "fr", "org", "us", "edu", "info", "biz", ".co.uk", ".cn")


def name_case(c: Column) -> Column:
    """Upper first letter, lower rest; one rule for the whole text, not per word."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def full_name(first: Column, last: Column) -> Column:
    """Null when either part is null."""
    return F.concat(name_case(first), F.lit(" "), name_case(last))


def norm_campaign(c: Column) -> Column:
    return name_case(F.trim(c))


def usd(c: Column) -> Column:
    return F.concat(F.lit("$"), F.round(c, 2).cast("decimal(18,2)").cast("string"))


def email_domain(c: Column) -> Column:
    """Text after the last ``@``, lower case; null when there is none."""
    return F.when(F.contains(c, F.lit("@")), F.substring_index(F.lower(c), "@", -1))


def external_email(c: Column, domains: Sequence[str], prefixes: Sequence[str] = ()) -> Column:
    """True for addresses outside the given domains and domain prefixes."""
    domain = email_domain(c)
    keep = ~domain.isin([d.lower() for d in domains])
    for p in prefixes:
        keep = keep & ~domain.startswith(p.lower())
    return keep


def like_any(c: Column, patterns: Sequence[str]) -> Column:
    """Case-insensitive LIKE against any of the patterns."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.lower(c).like(p.lower())
    return hit


def valid_mail_ending(c: Column, endings: Sequence[str] = MAIL_ENDINGS) -> Column:
    return like_any(c, [f"%{e}" for e in endings])


def pad_id(c: Column, width: int = 7) -> Column:
    """Left-pad with zeros; longer text is cut to ``width``."""
    return F.lpad(c.cast("string"), width, "0")


def norm_key(c: Column) -> Column:
    """A zero-padded text key as a number; null when it is not one."""
    return F.ltrim(c, F.lit("0")).try_cast("bigint")


def list_key(*parts: Column) -> Column:
    """Join with ``_``, skipping nulls."""
    return F.concat_ws("_", *parts)


def clean_money(c: Column) -> Column:
    return F.regexp_replace(c, r"[$,]", "").try_cast("decimal(18,2)")


def clean_phone(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def sub_id(provider: Column, affid: Column, subid: Column, sliced: Sequence[str]) -> Column:
    """Providers in ``sliced`` carry the sub id as the first four letters of the code."""
    return F.when(provider.isin(list(sliced)), F.left(affid, F.lit(4))).otherwise(subid)


def valid_state(c: Column, sentinel: str = "X-NotAvail", width: int = 2) -> Column:
    return F.when(c.isNull() | (F.length(c) > width), F.lit(sentinel)).otherwise(c)


def job_id(date: Column, cases: Sequence[tuple[Column, str, str]],
           default: tuple[str, str] | None = None) -> Column:
    """Prefix + MMddyyyy + suffix; the first matching case names both."""
    stamp = F.date_format(date, "MMddyyyy")
    out = None
    for cond, prefix, suffix in cases:
        value = F.concat(F.lit(prefix), stamp, F.lit(suffix))
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if default is not None:
        value = F.concat(F.lit(default[0]), stamp, F.lit(default[1]))
        out = value if out is None else out.otherwise(value)
    return out


def secret_hash(c: Column, salt: str) -> Column:
    """Account data is only ever compared as salted hashes."""
    return F.sha2(F.concat(F.lit(salt), c), 256)


def changed_flag(a: Column, b: Column) -> Column:
    """1 when two account values differ; nulls count as empty, only the last ``:`` part is read."""
    def last(c: Column) -> Column:
        return F.substring_index(F.coalesce(c, F.lit("")), ":", -1)
    return F.when(last(a) == last(b), 0).otherwise(1)


def bank_verification(returning: Column, no_bank_call: Column, routing_changed: Column,
                      account_changed: Column) -> Column:
    """RC for returning customers, else BV (call needed) or NBV (no call needed)."""
    no_call = F.coalesce(no_bank_call, F.lit(0))
    return (F.when(returning >= 1, "RC")
            .when(no_call == 0, "BV")
            .when((no_call == 1) & ((routing_changed == 1) | (account_changed == 1)), "BV")
            .when((no_call == 1) & (routing_changed == 0) & (account_changed == 0), "NBV"))
