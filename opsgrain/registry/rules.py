"""Rule data of the queries: names as they stand in the views of the test tables."""

from __future__ import annotations

from ..operators.classify import TextRule
from ..plans.sla import ChatType, SlaRules
from ..plans.volume import VolumeRules

# Business units counted, folded; unit, record types, teams, wait limits in seconds and queues of live chats.
SLA = SlaRules(
    units=("customer success - specialty", "customer success - core", "other"),
    chat_unit="CUSTOMER SUCCESS - CORE",
    chat_types=(ChatType("RD Chat", "RD", 60, "RD"), ChatType("Internal Advocate Success", "AST", 180, "AST")),
)

# Result texts of the remediation rules, this installation's wording.
REMEDIATION = {
    "central": "No Action Required: Handled by the central team",
    "mail_action": "Bulk Update Status to Closed: Resolved case with specialist email response & Resulting Action",
    "mail": "Bulk Update Status to Closed: Resolved case with specialist email response",
    "mail_open": "TBD: Unresolved case with specialist email response",
    "any_mail": "TBD: Resolved case with email response",
    "owned": "TBD: Resolved case with specialist ownership",
    "closed": "Requires Review: Complaint has closed date and case is resolved",
    "before_queue": "Requires Review: Case Resolved Before Escalation Queue",
    "none": "Requires Review: No Bucket",
}

CARD, PAY, COIN = "Card", "Pay", "Coin"
# Label and ILIKE patterns of the queue names with this installation's product names, first match wins.
QUEUES = (
    TextRule("AR", (f"%{COIN} IDV%", "%IDV Florida Limits%", "%IDV Manual Verification%", "%Compliance Review%")),
    TextRule("AR", ("%Risk EV Manual Verification%",)),
    TextRule("ATO", ("Risk ATO", "Risk ATO Voice", "ATO Brokerage and Lending", "%Messaging Risk ATO Specialty%")),
    TextRule("Disputes", (f"%{PAY} Disputes%",)),
    TextRule("Disputes", (f"%Disputes {CARD}%",)),
    TextRule("Disputes", ("%Disputes P2P%",)),
    TextRule("Disputes", ("%Disputes Service Claim%",)),
    TextRule("Disputes", ("%Priority Disputes%",)),
    TextRule("Disputes", ("%Disputes Specialty%",)),
    TextRule("Disputes", ("%Claim Docs%",)),
    TextRule("Remote Deposit Capture", ("%Mobile Check Deposits%",)),
    TextRule("Banking", ("%Banking%",)),
    TextRule("Banking", ("%Risk: Paper Money%",)),
    TextRule("Remote Deposit Capture", ("%Missing Deposits%",)),
    TextRule("Banking", (f"%{CARD} Suspension%",)),
    TextRule("Remote Deposit Capture", ("%Standard Deposit R06 and Reversal%",)),
)


def assignments(monitoring_label: str) -> tuple[TextRule, ...]:
    """Label and patterns of the assignment queues, first match wins; no match means the row is not counted."""
    return (
        TextRule("AR", ("%scam_payment%",)),
        TextRule("AR", ("%instrument_verification%",)),
        TextRule("AR", ("%enhanced_verification%",)),
        TextRule("AR", ("%risk_elder_abuse%", "%threat_of_harm%", "%brokerage_elder_abuse%")),
        TextRule("ATO", ("%ato%",)),
        TextRule("Remote Deposit Capture", ("%check_deposit_manual_review%",)),
        TextRule("AR", ("%idv%",)),
        TextRule("Remote Deposit Capture", ("rdc_returns_rars",), exact=True),
        TextRule(monitoring_label, ("TRANSACTION_MONITORING",), exact=True),
    )


ARRIVALS = VolumeRules(queue_rules=QUEUES, assignment_rules=assignments("Banking Fraud"))
TOUCHES = VolumeRules(queue_rules=QUEUES, assignment_rules=assignments("Banking Frauds"))
