"""Complaint records: touches, source of truth, model metrics, incidents, remediation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import business_days_between
from ..functions.dialect import PACIFIC, UTC, convert_tz, datediff_boundary, deep_link, ilike_any, like_plain, ntz, safe_ratio, trunc_date
from ..operators.calendar import calendar_spine
from ..operators.classify import case, incident_windows
from ..operators.history import first_event, latest_event
from ..operators.joins import asof_dim, dim_side
from ..operators.metrics import confusion_rates, distinct_counts, expected_rate, trailing_ratio
from ..operators.ordered import epoch_micros

Tables = Mapping[str, DataFrame]

# Statuses that end a complaint.
CLOSING = ("Closed", "Inquiry (Not a Complaint)", "Archived", "Withdrawn")


def _is_touch() -> Column:
    return F.coalesce(F.col("new_value").isin(*CLOSING), F.lit(False))


def handled_counts(history: DataFrame, status_field: str = "Status") -> DataFrame:
    """Closing status changes per complaint."""
    return history.filter((F.col("field") == status_field) & _is_touch()).groupBy("parent_id").agg(
        F.count(F.lit(1)).alias("handled_count")
    )


def touch_status_history(
    history: DataFrame, *, owner_field: str = "Owner", status_field: str = "Status", tie: Sequence[str] = ("new_value",)
) -> DataFrame:
    """First ownership and all status changes; closing ones count as touches."""
    first = first_event(history.filter(F.col("field") == owner_field), ["parent_id"], "created_at_utc", tie)
    status = history.filter(F.col("field") == status_field)
    cols = ["parent_id", "field", "old_value", "new_value", ntz("created_at_utc").alias("ts")]
    return first.select(*cols, F.lit(False).alias("is_touch")).union(status.select(*cols, _is_touch().alias("is_touch")))


def touch_owner_history(
    history: DataFrame, users: DataFrame, *, owner_field: str = "Owner", status_field: str = "Status"
) -> DataFrame:
    """Ownership changes with the name of the user (id rows only) and status changes."""
    cols = ["parent_id", "field", "old_value", "new_value", ntz("created_at_utc").alias("ts"), _is_touch().alias("is_touch")]
    owners = history.filter((F.col("field") == owner_field) & ~like_plain("new_value", "% %"))
    names = users.select(F.col("id").alias("created_by_id"), "name")
    a = owners.join(names, "created_by_id", "left").select(*cols, "name")
    b = history.filter(F.col("field") == status_field).select(*cols, F.col("new_value").alias("name"))
    return a.union(b)


# -- source of truth --------------------------------------------------------------------------

# Workflows answered to an outside party.
EXTERNAL = ("Regulatory", "Pre-Litigation", "BBB")
DEFAULT_UNIT_WORKFLOWS = ("Internal", "Regulatory", "Pre-Litigation", "BBB", "Global")
# Business-day limits of the internal workflow.
ACKNOWLEDGE_DAYS = 6
EARLY_DAYS = 5
FORMAL_DAYS = 15


def complaint_sla(df: DataFrame, bbb_response: Column, holidays=()) -> DataFrame:
    """Business-day limits and in-time flags per workflow."""
    flow = F.col("workflow")
    internal, external = flow == "Internal", flow.isin(*EXTERNAL)
    letters = flow.isin("Regulatory", "Pre-Litigation")
    central = F.col("is_central_team")

    def days(start: str, end: str) -> Column:
        return business_days_between(start, end, holidays)

    df = df.withColumns(
        {
            "response_due": F.when(external, F.col("response_due_ts_utc")),
            "external_response_sent": F.when(letters, F.col("external_response_sent_ts_utc")).when(flow == "BBB", bbb_response),
            "acknowledgement_sla_threshold": F.when(internal, ACKNOWLEDGE_DAYS),
            "time_to_acknowledge_business_days": F.when(internal, days("received_ts_utc", "acknowledged_ts_utc")),
            "early_resolution_sla_threshold": F.when(internal, EARLY_DAYS),
            "time_to_closure_business_days": F.when(internal | external, days("received_ts_utc", "closed_ts_utc")),
            "response_sla_threshold": F.when(internal, F.lit(FORMAL_DAYS).cast("bigint")).when(
                external, days("received_ts_utc", "response_due_ts_utc")
            ),
        }
    )

    def within(value: str, limit: str) -> Column:
        return F.coalesce(F.col(value) <= F.col(limit), F.lit(False))

    df = df.withColumns(
        {
            "is_in_acknowledgement_sla": F.when(
                internal & central, within("time_to_acknowledge_business_days", "acknowledgement_sla_threshold")
            ),
            "is_in_early_resolution_sla": F.when(
                internal & ~central, within("time_to_closure_business_days", "early_resolution_sla_threshold")
            ),
        }
    )
    formal = F.col("time_to_closure_business_days") <= F.col("response_sla_threshold")
    return df.withColumns(
        {
            # a NULL early flag (central team) is not "missed", so the formal flag is False
            "is_in_formal_response_sla": F.when(
                (internal & ~F.col("is_in_early_resolution_sla")) | external, formal
            ).otherwise(F.lit(False)),
            "investigation_days": F.when(internal, datediff_boundary("day", "created_ts_utc", "resolved_ts_utc"))
            .when(letters, datediff_boundary("day", "received_ts_utc", "investigated_ts_utc"))
            .when(flow == "BBB", datediff_boundary("day", "received_ts_utc", bbb_response.cast("timestamp_ntz"))),
        }
    )


def complaints_sot(
    t: Tables,
    *,
    default_unit: str,
    link_prefix: str = "",
    bbb_field: str = "date_responded_in_bbb",
    bbb_since: str = "2021-01-04",
    holidays=(),
) -> DataFrame:
    """One row per complaint with people, queue, outside response, limits and flags.

    Tables: ``complaints``, ``employees``, ``users``, ``queue_catalog``, ``complaint_history``,
    ``sponsored_accounts``, ``card_issuance``.
    """
    c = t["complaints"].filter(F.col("complaint_status").isNotNull())
    day = F.col("flagged_ts_utc")
    for role, key in (("modifier", "last_modified_by_id"), ("owner", "owner_id"), ("investigator", "investigator_id")):
        cols = {f"__{role}_id": "employee_id", f"__{role}_name": "full_name", f"__{role}_login": "uid"}
        c = asof_dim(c, t["employees"], (key, "agent_id"), day, cols, by_date=True)
    users = t["users"].select(F.col("id").alias("__u"), F.col("name").alias("__user_name"))
    queues = t["queue_catalog"].select(F.col("queue_id").alias("__q"), F.col("queue_name").alias("__queue_name"))
    c = c.join(dim_side(users), F.col("last_modified_by_id") == F.col("__u"), "left").join(queues, F.col("owner_id") == F.col("__q"), "left")

    answered = latest_event(
        t["complaint_history"].filter(F.col("field") == bbb_field), ["parent_id"], "created_at_utc", ["new_value"]
    ).select("parent_id", F.col("new_value").alias("__bbb"))
    banks = latest_event(t["card_issuance"], ["customer_token"], "created_at", ["sponsoring_bank"]).select(
        F.col("customer_token").alias("__ct"), "sponsoring_bank"
    )
    sponsored = t["sponsored_accounts"].select(F.col("dependent_customer_token").alias("__dep")).distinct()
    recent = F.col("created_ts_utc") >= F.lit(bbb_since).cast("timestamp_ntz")
    c = c.join(answered, (F.col("complaint_id") == F.col("parent_id")) & recent, "left")
    c = c.join(sponsored, F.col("customer_token") == F.col("__dep"), "left").join(banks, F.col("customer_token") == F.col("__ct"), "left")

    flow = F.col("workflow")
    c = c.withColumns(
        {
            "business_unit": F.when(flow.isin(*DEFAULT_UNIT_WORKFLOWS), F.coalesce("business_unit", F.lit(default_unit))).otherwise(
                F.col("business_unit")
            ),
            "owner_ref": F.coalesce(F.col("__owner_id").cast("string"), F.col("__q").cast("string")),
            "owner_name": F.coalesce("__owner_name", "__queue_name"),
            "modified_by_ref": F.coalesce(F.col("__modifier_id").cast("string"), F.col("__u").cast("string")),
            "modified_by_name": F.coalesce("__modifier_name", "__user_name"),
            "investigator_name": F.col("__investigator_name"),
            "is_central_team": F.when(flow.isin(*EXTERNAL), F.lit(True)).otherwise(F.coalesce("is_central_team", F.lit(False))),
            "is_external": F.coalesce(flow.isin(*EXTERNAL), F.lit(False)),
            "third_party_source": F.when(flow == "Regulatory", F.col("agency"))
            .when(
                flow == "Pre-Litigation",
                F.trim(F.concat(F.coalesce("customer_state", F.lit("")), F.lit(" "), F.coalesce("source_type", F.lit("")))),
            )
            .when(flow == "BBB", F.col("portal")),
            "pushback": F.when(flow == "Internal", F.lit(False))
            .when(flow.isin("Regulatory", "Pre-Litigation"), F.col("pushback"))
            .when(flow == "BBB", F.col("rejected_response")),
            "link": deep_link(F.col("complaint_id").cast("string"), link_prefix),
            "is_dependent_account": F.col("__dep").isNotNull(),
        }
    )
    out = complaint_sla(c, F.col("__bbb").try_cast("timestamp_ntz"), holidays)
    return out.drop(*[x for x in out.columns if x.startswith("__")], "parent_id").withColumnRenamed("sponsoring_bank", "third_party_provider")


# -- model metrics ------------------------------------------------------------------------------


def _reviewed(t: Tables) -> DataFrame:
    return t["support_cases"].join(t["model_comparison"].select("case_id", "has_complaint_reviewed", "has_complaint_model"), "case_id")


def model_metrics_monthly(t: Tables, *, min_reviewed: int = 1000, chat: str = "Chat", tz: str = PACIFIC) -> DataFrame:
    """Month rows with enough reviews: observed and model-based complaint rates."""
    base = _reviewed(t).withColumn(
        "month", trunc_date("month", convert_tz("case_creation_date_time", UTC, tz))
    )
    truth, pred = F.col("has_complaint_reviewed"), F.col("has_complaint_model")
    is_chat = F.col("origin") == chat
    flagged = (F.col("is_flagged_by_advocate") | F.col("is_flagged_by_model")) & is_chat
    rows = base.groupBy("month").agg(
        F.count(F.when(truth == 1, F.col("case_id"))).alias("cases_with_complaints"),
        F.count("case_id").alias("reviewed_cases"),
    ).filter(F.col("reviewed_cases") >= min_reviewed)
    rates = confusion_rates(base, ["month"], truth, pred)
    alert = distinct_counts(base, ["month"], "case_id", {"__flagged": flagged, "__chat": is_chat})
    out = rows.join(rates, "month").join(alert, "month")
    out = out.withColumn("chat_alert_rate", safe_ratio("__flagged", "__chat")).withColumns(
        {
            "observed_rate": safe_ratio("cases_with_complaints", "reviewed_cases"),
            "expected_rate": expected_rate("chat_alert_rate", "precision", "recall"),
            "expected_rate_v2": safe_ratio(F.col("fn") + F.col("tp"), "reviewed_cases"),
        }
    )
    # one row per month: the window is over a report
    newest = F.row_number().over(Window.orderBy(F.col("month").desc())) == 1
    return out.withColumn("most_recent_month", newest).drop("__flagged", "__chat", "tp", "fn", "fp")


def flag_counts(t: Tables, chat: str = "Chat") -> DataFrame:
    base = _reviewed(t)
    flagged = (F.col("is_flagged_by_advocate") | F.col("is_flagged_by_model")) & (F.col("origin") == chat)
    return base.agg(
        F.count(F.when(flagged, F.col("case_id"))).alias("flagged_by_advocate"),
        F.count(F.when(F.col("has_complaint_reviewed") == 1, F.col("case_id"))).alias("flagged_by_review"),
    )


def model_metrics_table(
    t: Tables, *, review_since: str, data_since: str, months_from: str, months_to: str, chat: str = "Chat", tz: str = PACIFIC,
    all_time: bool = True,
) -> DataFrame:
    """Month rows with review, model and identification rates and trailing three months.

    Recall and precision are all-time values put on every month of the calendar
    (``all_time=False`` computes them per month instead).
    """
    since = F.lit(data_since).cast("timestamp_ntz")
    cases = t["support_cases"].withColumn("month", trunc_date("month", convert_tz("created_at_utc", UTC, tz)))
    judged = t["model_comparison"].select(F.col("case_id").alias("__m"), "has_complaint_reviewed")
    reviewed = cases.filter(F.col("month") >= F.lit(review_since).cast("date")).join(judged, F.col("case_id") == F.col("__m"), "left")
    review = distinct_counts(
        reviewed, ["month"], "case_id", {"flagged_by_review": F.col("has_complaint_reviewed") == 1, "reviewed_cases": F.col("__m").isNotNull()}
    ).withColumn("review_expected_rate", safe_ratio("flagged_by_review", "reviewed_cases"))

    scored = t["model_comparison"].filter(F.col("case_creation_date_time") >= since)
    truth, pred = F.col("has_complaint_reviewed"), F.col("has_complaint_model")
    if all_time:
        # the one row of rates is repeated for every month of the calendar
        first, stop = F.lit(months_from).cast("date"), F.lit(months_to).cast("date")
        every = F.sequence(first, F.date_sub(stop, 1), F.expr("interval 1 month"))
        model = confusion_rates(scored, [], truth, pred, "case_id").select("recall", "precision", F.explode(every).alias("month"))
    else:
        spine = calendar_spine(cases.sparkSession, months_from, months_to, "month").select(F.col("report_date").alias("month"))
        monthly = scored.withColumn("month", trunc_date("month", "case_creation_date_time"))
        model = spine.join(confusion_rates(monthly, ["month"], truth, pred, "case_id").select("month", "recall", "precision"), "month", "left")

    recent = cases.filter(F.col("created_at_utc") >= since)
    alert = distinct_counts(recent, ["month"], "case_id", {"__flag": F.col("is_flagged_by_model"), "__elig": F.col("origin") == chat})
    alert = trailing_ratio(
        alert.withColumn("model_alert_rate", safe_ratio("__flag", "__elig")), "__flag", "__elig", "month", "model_alert_rate_3m"
    ).drop("__flag", "__elig")
    known = t["complaints"].filter(F.col("workflow") == "Internal").select(F.col("case_id").alias("__c")).filter("__c is not null").distinct()
    flags = distinct_counts(
        recent.join(known, F.col("case_id") == F.col("__c"), "left"), ["month"], "case_id", {"__with": F.col("__c").isNotNull(), "__all": None}
    )
    flags = trailing_ratio(flags.withColumn("flagging_rate", safe_ratio("__with", "__all")), "__with", "__all", "month", "flagging_rate_3m").drop(
        "__with", "__all"
    )
    # the flagging rates hang on the alert rates, so a month without these has neither
    rates = alert.join(flags, "month", "left")
    out = review.join(rates, "month", "left").join(model, "month", "left")
    out = out.withColumn("model_expected_rate", expected_rate("model_alert_rate", "precision", "recall")).withColumns(
        {
            "review_identification_rate": safe_ratio("flagging_rate", "review_expected_rate"),
            "model_identification_rate": safe_ratio("flagging_rate", "model_expected_rate"),
        }
    )
    best = Window.orderBy(F.col("model_expected_rate").isNotNull().desc(), F.col("month").desc())
    return out.withColumn("most_recent_valid_month", F.row_number().over(best) == 1)


# -- incidents and remediation --------------------------------------------------------------------


def incident_prospects(
    messages: DataFrame, prospects: DataFrame, incidents: Sequence[tuple[str, str, str]], *, as_of: str, sender: str = "CUSTOMER"
) -> DataFrame:
    """First detected prospect per conversation among customer messages inside an incident."""
    inside = incident_windows(messages.filter(F.col("sender") == sender), "message_at_utc", incidents)
    joined = inside.join(prospects, inside["message_token"] == prospects["chat_message_token"])
    first = first_event(joined, ["conversation_token"], "detected_at", ["message_token"])
    return first.select(
        "message_token", "message_at_utc", "conversation_token", "detected_at", "incident_label", "incident_start", "incident_end",
        business_days_between("detected_at", F.lit(as_of).cast("date")).alias("age_business_days"),
    )


def remediation_list(
    t: Tables, *, specialist: Sequence[str], escalation_queue: str, business_unit: str, texts: Mapping[str, str], link_prefix: str = "",
    skip_workflows: Sequence[str] = ("Lending", "Investing", "Global"),
    skip_statuses: Sequence[str] = ("Inquiry (Not a Complaint)", "Withdrawn"),
    countries: Sequence[str] = ("United States", "Unknown"),
) -> DataFrame:
    """Open tier-2 complaints with the next step each needs.

    Tables: ``complaints``, ``cases``, ``owner_history``, ``emails``, ``employees``.  ``texts``: the result of each rule, in their
    order central, mail_action, mail, mail_open, any_mail, owned, closed, before_queue, and none.
    """
    cases = t["cases"]
    def is_specialist(team: str) -> Column:
        return ilike_any(team, specialist)

    owners = asof_dim(
        t["owner_history"], t["employees"], ("new_value", "agent_id"), "created_at_utc", {"team_code": "team_code"}, by_date=False, how="inner"
    ).filter(is_specialist("team_code"))
    queued = t["owner_history"].filter(F.col("new_name") == escalation_queue)
    mails = asof_dim(
        t["emails"].filter(F.col("direction") == "outgoing"), t["employees"], ("created_by_id", "agent_id"), "email_created_at",
        {"team_code": "team_code"}, by_date=False, how="inner",
    )
    # a sender without team code wins over a specialist, then the latest mail
    special = is_specialist("team_code")
    newest = F.struct(
        F.when(special.isNull(), 0).when(special, 1).otherwise(2).alias("rank"), F.col("email_created_at").isNull().alias("undated"),
        (-epoch_micros(F.col("email_created_at"))).alias("age"), F.col("email_id"),
    )
    # one row per case out of one aggregate: a shuffle and a sort for the three sides together
    facts = owners.select("case_id", F.lit(True).alias("__owned"))
    facts = facts.unionByName(queued.select("case_id", F.col("created_at_utc").alias("__queued_at")), allowMissingColumns=True)
    facts = facts.unionByName(mails.select("case_id", newest.alias("__mail"), "team_code"), allowMissingColumns=True)
    firsts = facts.groupBy("case_id").agg(
        F.max("__owned").alias("__owned"), F.min("__queued_at").alias("__queued_at"), F.min_by("team_code", "__mail").alias("__mail_team")
    )

    c = t["complaints"].filter((F.col("complaint_status") == "In Progress") & (F.col("severity_tier") == "Tier 2"))
    gate = (
        ~F.col("is_duplicate")
        & ~F.col("workflow").isin(*skip_workflows)
        & ~F.col("complaint_status").isin(*skip_statuses)
        & (F.col("business_unit") == business_unit)
        & ~like_plain(F.coalesce("third_party_source", F.lit("")), "%investigation%", ignore_case=True)
        & F.coalesce("country", F.lit("United States")).isin(*countries)
    )
    c = c.filter(gate)
    slim = cases.select(
        "case_id", "case_number", "status", "case_creation_date_time_utc", F.coalesce("first_resolved_at", "last_resolved_at").alias("__resolved")
    )
    for side in (slim, firsts):
        c = c.join(side, "case_id", "left")
    done = F.col("status").isin("Closed", "Resolved")
    special = F.coalesce(is_specialist("__mail_team"), F.lit(False))
    bucket = case(
        [
            (F.col("is_central_team"), texts["central"]),
            (special & done & F.col("resulting_action").isNotNull(), texts["mail_action"]),
            (special & done, texts["mail"]),
            (special & ~done, texts["mail_open"]),
            (F.col("__mail_team").isNotNull() & done, texts["any_mail"]),
            (F.col("__owned").isNotNull() & done, texts["owned"]),
            (done & F.col("closed_ts_utc").isNotNull(), texts["closed"]),
            (F.col("__queued_at") > F.col("__resolved"), texts["before_queue"]),
        ],
        F.lit(texts["none"]),
    )
    return c.select(
        bucket.alias("remediation_bucket"), "case_number", "case_id", "case_creation_date_time_utc",
        deep_link(F.col("case_id").cast("string"), link_prefix).alias("link"), "complaint_id", "complaint_status",
        "created_ts_utc", "review_notes",
    )


def distinct_notes(remediation: DataFrame) -> DataFrame:
    return remediation.select("review_notes").distinct()
