"""Web funnels and signing time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendreach.functions.flags import cond_agg, flag_any, one
from lendreach.operators.joins import interval_join
from lendreach.operators.ranking import first_visit, page_dwell

# The pages of the internal funnel.
INTERNAL_PAGES = tuple(
    f"{p}{s}" for p in ("account_terms", "personal_info", "address_info", "living_situation",
                        "payment_schedule", "pre_approved", "employment_info", "banking_info")
    for s in ("", "_submit")) + tuple(
    f"loan_docs{s}-{d}" for d in ("CI", "TC", "TILA", "ACH", "ARB") for s in ("", "_submit")) + (
    "create_password_submit", "user_account")
# The document steps of the external funnel, per state.
EXTERNAL_DOCS = {"TN": ("CI", "TC", "TILA", "ACH", "ARB"),
                 "TX": ("CI", "CSD", "CSA", "PP", "LA", "ACH")}


def flag_name(page: str) -> str:
    return "p_" + page.lower().replace("-", "_")


def funnel_internal(events: DataFrame, start: str, since, pages: Sequence[str] = INTERNAL_PAGES,
                    key: str = "user_name", received: str | None = None, offer: str = "pre_approved_submit",
                    identity: str = "kyc_submit", bank: str = "banking_info_submit") -> DataFrame:
    """Page flags per user for users who began at the start page since a date, and the positions of a reject:
    before the offer was taken; after it but before identity was confirmed; and, for users who gave their bank,
    at or after the time their lead came in (``received``: that time on each event, null where it has no lead).

    Whether a user began is one more flag of the same aggregation: no second pass, no join.
    """
    recent = events.filter(F.col("event_ts") >= since)
    page = F.col("page")
    flags = [flag_any(page == p).alias(flag_name(p)) for p in pages]
    late = (page == "reject") & (F.col(received) <= F.col("event_ts")) if received else F.lit(False)
    marks = {"_offer": page == offer, "_identity": page == identity, "_bank": page == bank, "_late": late}
    df = recent.groupBy(key).agg(
        flag_any(page == start).alias("_started"), *flags, flag_any(page == "reject").alias("reject"),
        flag_any(page.contains("-ro")).alias("is_rollback"), F.count("*").alias("events"),
        *[flag_any(c).alias(n) for n, c in marks.items()])
    rejected = F.col("reject") == 1
    return df.filter("_started = 1").withColumns({
        "reject_before_offer": one(rejected & (F.col("_offer") == 0)),
        "reject_after_offer": one(rejected & (F.col("_offer") == 1) & (F.col("_identity") == 0)),
        "reject_after_lead": one((F.col("_late") == 1) & (F.col("_bank") == 1))}).drop("_started", *marks)


def funnel_ordered(events: DataFrame, steps: Sequence[str], key: str = "user_name", ts: str = "event_ts",
                   tie: str = "id", grain: str = "day") -> DataFrame:
    """(key, steps_done, t_1 … t_k): how far each user got through ``steps`` in their order, and when. A step
    counts only after the one before it; events follow time, ties ``tie``.

    A user's events of one time bucket become a small transition table: for every step the user may have reached
    before, the step reached after and the times on the way. Tables are put together in time order, one a bucket,
    so a user with very many events is spread over buckets and only pages of the funnel are kept at all.
    """
    n = len(steps)
    number = F.create_map(*[x for i, p in enumerate(steps) for x in (F.lit(p), F.lit(i))])[F.col("page")]
    seen = events.withColumn("_step", number).filter(F.col("_step").isNotNull())
    moments = F.transform(F.array_sort(F.collect_list(F.struct(F.col(ts).alias("at"), F.col(tie).alias("tie"),
                                                               F.col("_step").alias("step")))),
                          lambda e: F.struct(e["step"].alias("step"), e["at"].alias("at")))
    chunks = seen.groupBy(key, F.date_trunc(grain, ts).alias("_bucket")).agg(moments.alias("_moments"))

    def walk(begin: int):
        """State and times after the bucket for a user who had reached step ``begin`` before it."""
        start = F.struct(F.lit(begin).alias("done"), F.array().cast("array<timestamp_ntz>").alias("times"))
        return F.aggregate("_moments", start, lambda s, e: F.when(
            e["step"] == s["done"], F.struct((s["done"] + 1).alias("done"),
                                             F.array_append(s["times"], e["at"]).alias("times"))).otherwise(s))

    tables = chunks.select(key, F.struct("_bucket", F.array(*[walk(i) for i in range(n + 1)]).alias("walks")).alias("_c"))
    begin = F.struct(F.lit(0).alias("done"), F.array().cast("array<timestamp_ntz>").alias("times"))
    folded = tables.groupBy(key).agg(F.array_sort(F.collect_list("_c")).alias("_all")).select(
        key, F.aggregate("_all", begin, lambda s, c: F.struct(
            c["walks"][s["done"]]["done"].alias("done"),
            F.concat(s["times"], c["walks"][s["done"]]["times"]).alias("times"))).alias("_end"))
    return folded.select(key, F.col("_end.done").alias("steps_done"),
                         *[F.get("_end.times", F.lit(i)).alias(f"t_{i + 1}") for i in range(n)])


def funnel_external(apps: DataFrame, events: DataFrame, welcome: Sequence[str],
                    steps: Sequence[str], docs: Mapping[str, Sequence[str]],
                    key: str = "lms_customer_id", received: str = "received_time") -> DataFrame:
    """Per application: pages seen after the lead arrived, a redirect within [-2, +5] minutes,
    and the document steps of the application's own state.

    "Seen after" only needs each page's last time, so events shrink to one row per customer
    before they meet the applications.
    """
    wanted = {p: ("max", F.col("page") == p, F.col("event_ts"))
              for p in dict.fromkeys([*welcome, *steps, *[f"loan_docs{s}-{d}" for ds in docs.values()
                                                          for d in ds for s in ("", "_submit")]])}
    last = events.groupBy(key).agg(*cond_agg({flag_name(p): w for p, w in wanted.items()}),
                                   F.max(F.when(F.col("page").contains("-ro"), F.col("event_ts")))
                                   .alias("_rollback"))
    hits = interval_join(apps.select("lms_application_id", key, received),
                         events.filter(F.col("page").isin(list(welcome))).select(key, "event_ts"),
                         key, received, "event_ts", -2, 5)
    redirected = hits.select("lms_application_id").distinct().withColumn("_redirect", F.lit(1))
    df = apps.join(last, key, "left").join(redirected, "lms_application_id", "left")

    def after(p: str):
        return F.col(flag_name(p)) >= F.col(received)
    seen_welcome = F.lit(False)
    for p in welcome:
        seen_welcome = seen_welcome | F.coalesce(after(p), F.lit(False))
    out = [one(F.col("_redirect") == 1).alias("is_redirect"), one(seen_welcome).alias("visit_welcome")]
    out += [one(after(p)).alias("s_" + flag_name(p)[2:]) for p in steps]
    for state, names in docs.items():
        here = F.col("state") == state
        for d in names:
            for s in ("", "_submit"):
                p = f"loan_docs{s}-{d}"
                out.append(one(here & after(p)).alias(f"d_{flag_name(p)[2:]}_{state.lower()}"))
        out.append(one(here & after(f"loan_docs_submit-{names[-1]}"))
                   .alias(f"completed_loan_doc_{state.lower()}"))
    out.append(one(F.col("_rollback") >= F.col(received)).alias("is_rollback"))
    return df.select("lms_application_id", key, received, "state", *out)


def signing_pages(events: DataFrame, groups: Mapping[str, str], lead: str,
                  keys: Sequence[str]) -> DataFrame:
    """First visit per user, lead and page group, with the seconds spent."""
    visits = page_dwell(events, keys, "page", "event_ts", dict(groups))
    return first_visit(visits, [k for k in keys if k != "session_id"] + ["page_group"])


def signing_time(events: DataFrame, apps: DataFrame, groups: Mapping[str, str],
                 lead: str, keys: Sequence[str]) -> DataFrame:
    """Seconds spent signing per lead, with the product and new or returning mark."""
    total = signing_pages(events, groups, lead, keys).groupBy(lead).agg(
        F.sum("seconds_spent").alias("total_seconds_spent"),
        F.count_distinct("page_group").alias("page_groups"))
    info = apps.select(lead, "state", "product", "loan_sequence", "isoriginated")
    return total.join(info, lead).withColumn("is_nc", one(F.col("loan_sequence") == 1))
