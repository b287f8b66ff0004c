"""Domain constants of the hiring data model.

Fixed values: these must equal the source system's vocabulary for the
results to line up (stage names, terminal states, SLA targets, exception
type and severity labels, constraint domains). Kept together, in natural
order, as plain text.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
STAGES = ("APPLIED", "SCREEN", "ONSITE", "OFFER", "HIRED", "REJECTED", "WITHDRAWN")
TERMINAL_STAGES = ("HIRED", "REJECTED", "WITHDRAWN")
ACTOR_TYPES = ("Recruiter", "System", "Candidate")
LEVELS = ("IC1", "IC2", "IC3", "IC4", "IC5")
DECISIONS = ("ACCEPTED", "DECLINED", "EXPIRED")
COMP_BANDS = ("A", "B", "C")

# transition name -> (start stage column, end column, duration column, target days)
SLA_TRANSITIONS = (
    ("APPLIED_TO_SCREEN", "applied_ts", "screen_ts", "days_applied_to_screen", 3),
    ("SCREEN_TO_ONSITE", "screen_ts", "onsite_ts", "days_screen_to_onsite", 10),
    ("ONSITE_TO_OFFER", "onsite_ts", "offer_ts", "days_onsite_to_offer", 7),
    ("OFFER_TO_DECISION", "offer_ts", "decision_ts", "days_offer_to_decision", 5),
)

EXC_ORPHAN = ("ORPHAN_STAGE_EVENT", "HIGH")
EXC_DUPLICATE = ("DUPLICATE_APPLICATION", "MED")
EXC_MISSING_RECRUITER = ("MISSING_RECRUITER", "LOW")
EXC_STAGE_ORDER = ("STAGE_ORDER_VIOLATION", "HIGH")
EXC_NEGATIVE_DURATION = ("NEGATIVE_DURATION", "HIGH")
EXC_MULTIPLE_TERMINAL = ("MULTIPLE_TERMINAL_EVENTS", "HIGH")
EXC_OFFER_BEFORE_ONSITE = ("OFFER_BEFORE_ONSITE", "MED")
EXC_OFFER_WITHOUT_ONSITE = ("OFFER_WITHOUT_ONSITE", "MED")

DUPLICATE_WINDOW_DAYS = 30
SLA_PERCENTILE = 0.9
# --- end of fixed values ----------------------------------------------------

# Column name of each stage timestamp in the lifecycle row.
STAGE_COLUMNS = {s: f"{s.lower()}_ts" for s in STAGES}
# Human-readable exception texts (our own wording).
EXCEPTION_DETAILS = {
    "ORPHAN_STAGE_EVENT": "stage event points at an application that does not exist",
    "MISSING_RECRUITER": "application has no recruiter assigned",
    "SCREEN_AFTER_ONSITE": "screen happened after onsite",
    "ONSITE_AFTER_OFFER": "onsite happened after offer",
    "NEGATIVE_DURATION": "at least one stage duration is negative",
    "MULTIPLE_TERMINAL_EVENTS": "more than one of hired, rejected, withdrawn is recorded",
    "OFFER_BEFORE_ONSITE": "offer record is dated before the onsite stage",
    "OFFER_WITHOUT_ONSITE": "offer record exists but no onsite stage was recorded",
}
