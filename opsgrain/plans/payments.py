"""Payments matched with the records that explain them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import PACIFIC, UTC, convert_tz, like_plain, regexp_first, trunc
from ..operators.classify import union_distinct
from ..operators.history import first_and_count, nulls_last
from ..operators.joins import asof_dim
from ..operators.match import evidence_flags, tolerance_scan
from ..operators.metrics import with_totals

Tables = Mapping[str, DataFrame]

DAY = 86400
# Formats of the references written into comments.
CASE_NUMBER = "[0-9]{8}([0-9]{1})?"
COMPLAINT_NUMBER = "CCN-[0-9]+"


def comment_references(df: DataFrame, comment: str) -> DataFrame:
    """Case and complaint number found in a comment, NULL where there is none."""
    return df.withColumns(
        {"case_number": regexp_first(comment, CASE_NUMBER), "complaint_number": regexp_first(comment, COMPLAINT_NUMBER)}
    )


def _cases(t: Tables, case_cols: Mapping[str, str]) -> DataFrame:
    return t["support_cases"].select(F.col("case_number").alias("__number"), *[F.col(s).alias(n) for n, s in case_cols.items()])


def _with_case(t: Tables, action: str, cases: DataFrame) -> DataFrame:
    """Audit rows of one kind of action with the row of ``cases`` for the number in their comment."""
    logs = t["audit_logs"].filter(like_plain("action_name", action, ignore_case=True)).select(
        F.col("entity_token").alias("customer_token"), F.col("id").alias("audit_id"), F.col("created_at").alias("audit_at"),
        F.col("comment").alias("audit_comment"), F.col("action_name").alias("audit_action"), "actor_uid",
        regexp_first("comment", CASE_NUMBER).alias("__number"),
    )
    return logs.join(cases.filter(F.col("__number").isNotNull()), "__number", "left").withColumnRenamed("__number", "case_number")


def _audits(t: Tables, action: str, case_cols: Mapping[str, str]) -> DataFrame:
    """Audit rows of one kind of action with the case their comment names."""
    return _with_case(t, action, _cases(t, case_cols))


def _employee(df: DataFrame, employees: DataFrame) -> DataFrame:
    cols = {"agent_id": "agent_id", "agent_team": "team_code"}
    return asof_dim(df, employees, ("actor_uid", "uid"), "created_at", cols, by_date=False)


def _rows(*counts: str) -> Column:
    """Rows a chain of left joins makes: each side counts at least once."""
    out = F.lit(1).cast("bigint")
    for c in counts:
        out = out * F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(1))
    return out


_AUDIT_COLS = ["audit_id", "audit_at", "audit_comment", "audit_action", "actor_uid", "case_number"]


def reimbursed(
    payments: DataFrame, *, sender_token, since: str, mechanism: str = "REIMBURSEMENT", state: str = "PAID_OUT"
) -> DataFrame:
    """Paid reimbursements; ``payments`` may be a stream."""
    return payments.filter(
        (F.col("creation_mechanism") == mechanism)
        & (F.col("sender_token") == sender_token)
        & (F.col("created_at") >= F.lit(since).cast("timestamp_ntz"))
        & (F.col("state") == state)
    ).withColumn("customer_token", F.col("recipient_token"))


_REIMBURSED_CASE = {"case_id": "case_id", "case_origin": "origin"}


def _flow(t: Tables) -> DataFrame:
    return t["case_payments"].select(
        F.col("case_id").alias("__fc"), F.col("payment_id").alias("case_payment_id"), F.col("banking_token").alias("case_banking_token")
    )


def reimbursement_audits(t: Tables, action: str = "%reimburse%") -> DataFrame:
    """Audit entries with the case that they name and what is known of its payment; ``audit_logs`` may be a stream."""
    audits = _audits(t, action, _REIMBURSED_CASE)
    return audits.join(_flow(t), F.col("case_id") == F.col("__fc"), "left").drop("__fc")


def paid_cases(t: Tables) -> DataFrame:
    """Cases by their number, each with the one of its payments that ``AUDIT_MATCH`` prefers and ``__weight``, their number (1 without any)."""
    flow = _flow(t).filter(F.col("__fc").isNotNull())
    # the order of a match among rows of one audit entry and case: nothing else tells them apart
    best = F.min(F.struct((~audit_preferred()).alias("rest"), "case_payment_id", "case_banking_token"))
    flow = flow.groupBy("__fc").agg(best.alias("__best"), F.count(F.lit(1)).alias("__n"))
    cases = _cases(t, _REIMBURSED_CASE).join(flow, F.col("case_id") == F.col("__fc"), "left")
    return cases.select(
        "__number", *_REIMBURSED_CASE, F.col("__best.case_payment_id").alias("case_payment_id"),
        F.col("__best.case_banking_token").alias("case_banking_token"), F.coalesce("__n", F.lit(1)).alias("__weight"),
    )


def weighted_audits(t: Tables, cases: DataFrame, action: str = "%reimburse%") -> DataFrame:
    """``reimbursement_audits`` with one row per entry and case, that of the best payment; ``__weight`` of ``cases`` (``paid_cases``) is how many it stands for.

    A match out of them, weighted, is the one out of all rows, and a stream keeps as many rows fewer as cases have payments.
    """
    audits = _with_case(t, action, cases)
    return audits.withColumn("__weight", F.coalesce("__weight", F.lit(1)))


#: How the audit entry of a reimbursement is found: arguments of ``tolerance_scan``, or of its form on streams.
AUDIT_MATCH = {
    "key": "customer_token", "left_ts": "created_at", "right_ts": "audit_at", "row_id": "payment_id", "count": "__n_audit",
    "cols": {c: c for c in [*_AUDIT_COLS, "case_id", "case_origin", "case_payment_id", "case_banking_token"]},
    "before_seconds": DAY, "after_seconds": DAY, "tie": ["audit_id", "case_payment_id"],
}


def audit_preferred() -> Column:
    return F.col("case_banking_token").isNull()


def match_reimbursements(
    t: Tables,
    *,
    sender_token,
    since: str,
    action: str = "%reimburse%",
    mechanism: str = "REIMBURSEMENT",
    state: str = "PAID_OUT",
    tz: str = PACIFIC,
    count_before_dedupe: bool = True,
    best: DataFrame | None = None,
) -> DataFrame:
    """Paid reimbursements with audit entry, case, assignment and evidence flags, one row each.

    Tables: ``payments``, ``audit_logs``, ``employees``, ``support_cases``, ``case_payments``,
    ``assignments``.  The audit entry is the best one within a day either way, the second
    case the earliest one of the three days before.  None of the time-tolerant joins is run
    as a join: the picks are ordered scans and the number of joined rows, which
    ``payments_per_customer`` counts (``count_before_dedupe``), is a product of counts.
    ``best`` brings the audit entries from elsewhere, such as a stream (``AUDIT_MATCH`` with ``streaming.stateful.stream_match``).
    """
    pay = reimbursed(t["payments"], sender_token=sender_token, since=since, mechanism=mechanism, state=state)
    if best is None:
        best = tolerance_scan(pay, reimbursement_audits(t, action), prefer=audit_preferred(), **AUDIT_MATCH)
    # cases of the three days before
    recent = t["support_cases"].select(
        "customer_token", F.col("created_at_utc").alias("recent_case_at"), F.col("case_id").alias("recent_case_id"),
        F.col("case_number").alias("recent_case_number"),
    )
    before = tolerance_scan(
        pay, recent, "customer_token", "created_at", "recent_case_at", {c: c for c in recent.columns if c != "customer_token"},
        row_id="payment_id", count="__n_recent", before_seconds=3 * DAY, after_seconds=0, tie=["recent_case_id"],
    )
    out = pay.join(best, "payment_id", "left").join(before, "payment_id", "left")
    out = _employee(out, t["employees"])

    # assignments of the same customer and calendar day
    day = convert_tz("occurred_at", UTC, tz).cast("date")
    duties = t["assignments"].filter(F.col("customer_token").isNotNull()).withColumn("__day", day)
    first_duty = first_and_count(duties, ["customer_token", "__day"], nulls_last("occurred_at", "assignment_id"), "__n_duty").select(
        "customer_token", "__day", "assignment_id", F.col("queue").alias("assignment_queue"), F.col("submitted_at").alias("assignment_submitted_at"),
        "__n_duty",
    )
    out = out.withColumn("__day", F.col("created_at").cast("date"))
    out = out.join(first_duty, ["customer_token", "__day"], "left").drop("__day")

    # cases that carry the payment itself
    linked = t["case_payments"].filter(F.col("payment_id").isNotNull()).groupBy("payment_id").agg(
        F.min("case_id").alias("linked_case_id"), F.count(F.lit(1)).alias("__n_link")
    )
    out = out.join(linked, "payment_id", "left")

    rows = _rows("__n_audit", "__n_duty", "__n_recent", "__n_link") if count_before_dedupe else F.lit(1).cast("bigint")
    out = with_totals(out.withColumn("__rows", rows), ["recipient_token"], {"payments_per_customer": ("sum", F.col("__rows"))})
    out = evidence_flags(
        out,
        {
            "has_case_from_audit": "case_id",
            "has_assignment": "assignment_submitted_at",
            "has_recent_case": "recent_case_id",
            "has_payment_on_case": "linked_case_id",
            "has_audit": "audit_id",
        },
    )
    return out.withColumn("type", F.lit("P2P Reimbursement")).drop(*[c for c in out.columns if c.startswith("__")])


def _same_second(pay: DataFrame, audits: DataFrame, rank: Sequence[Column]) -> DataFrame:
    """Best audit row of the same customer and second; the audits shrink to one row per second first."""
    keyed = audits.withColumn("__second", trunc("second", "audit_at"))
    side = first_and_count(keyed, ["customer_token", "__second"], rank, "__n_audit").withColumnRenamed("customer_token", "__token")
    joined = pay.withColumn("__s", trunc("second", "created_at"))
    return joined.join(
        side, (F.col("recipient_token") == F.col("__token")) & (F.col("__s") == F.col("__second")), "left"
    ).drop("__s", "__second", "__token")


def reimbursements_and_refunds(
    t: Tables, *, sender_token, since: str, action: str = "%reimburse%", mechanism: str = "REIMBURSEMENT", state: str = "PAID_OUT"
) -> DataFrame:
    """Reimbursements (new payment) and refunds (reversed payment), rows distinct."""
    recent = t["payments"].filter(F.col("created_at") >= F.lit(since).cast("timestamp_ntz"))
    case_cols = {"case_id": "case_id", "case_at": "created_at_utc", "case_banking_token": "banking_token", "case_origin": "origin"}
    audits = _audits(t, action, case_cols)

    new = recent.filter(
        (F.col("creation_mechanism") == mechanism) & (F.col("sender_token") == sender_token) & (F.col("state") == state)
    )
    # audits without a bank token on the case win, then the earliest
    a = _same_second(new, audits, [F.col("case_banking_token").isNotNull(), *nulls_last("audit_at"), F.col("audit_id")])
    a = with_totals(a.withColumn("__rows", _rows("__n_audit")), ["recipient_token"], {"payments_per_customer": ("sum", F.col("__rows"))})
    a = a.withColumns({"type": F.lit("P2P Reimbursement"), "customer_token": F.col("recipient_token")})

    back = recent.filter((F.col("failure_reason") == "MANUALLY_REVERSED") & (F.col("pull_result") == "SUCCESS"))
    plain = audits.drop("case_number", *case_cols)
    b = _same_second(back, plain, [*nulls_last("audit_at"), F.col("audit_id")])
    cases = t["support_cases"].filter(F.col("payment_id").isNotNull())
    own = first_and_count(cases, ["payment_id"], nulls_last("created_at_utc", "case_id"), "__n_case").select(
        "payment_id", "case_number", *[F.col(s).alias(n) for n, s in case_cols.items()], "__n_case"
    )
    b = b.join(own, "payment_id", "left")
    b = with_totals(
        b.withColumn("__rows", _rows("__n_audit", "__n_case")), ["sender_token"], {"payments_per_customer": ("sum", F.col("__rows"))}
    )
    b = b.withColumns({"type": F.lit("Refund"), "customer_token": F.col("sender_token")})

    cols = [*t["payments"].columns, "type", "customer_token", *_AUDIT_COLS, *case_cols, "payments_per_customer"]
    sides = [_employee(x.select(*cols), t["employees"]) for x in (a, b)]
    schema = {f.name: f.dataType.simpleString() for f in sides[0].schema.fields}
    return union_distinct(sides, schema)
