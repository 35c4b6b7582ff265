"""Business rules as Catalyst expressions.

No UDFs: each rule is a ``CASE WHEN`` chain or a string builtin, so it runs
inside whole-stage codegen next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed values that must equal the reference's for the same labels.
PASS_MARK = 75
FRAUD_HIGH = 0.7
FRAUD_MEDIUM = 0.3
NORMAL_LOW = 0.15
LOAN_LOW_BELOW = 0.30
LOAN_MEDIUM_BELOW = 0.55
LOAN_RECOMMENDATION = {
    "LOW": "Approved — Standard loan terms apply",
    "MEDIUM": "Conditional Approval — Additional review required",
    "HIGH": "Rejected — Default risk exceeds acceptance threshold",
}


# ---------------------------------------------------------------- P13
def pass_fail(score, mark: int = PASS_MARK) -> Column:
    """PASS when score >= mark, else FAIL (null score -> null)."""
    s = _c(score)
    return F.when(s >= mark, F.lit("PASS")).when(s.isNotNull(), F.lit("FAIL"))


# ---------------------------------------------------------------- P14
def fraud_label(score) -> Column:
    s = _c(score)
    return (F.when(s >= FRAUD_HIGH, F.lit("FRAUD"))
            .when(s >= FRAUD_MEDIUM, F.lit("FRAUD"))
            .when(s.isNotNull(), F.lit("NORMAL")))


def fraud_confidence(score) -> Column:
    s = _c(score)
    return (F.when(s >= FRAUD_HIGH, F.lit("HIGH"))
            .when(s >= FRAUD_MEDIUM, F.lit("MEDIUM"))
            .when(s >= NORMAL_LOW, F.lit("LOW"))
            .when(s.isNotNull(), F.lit("HIGH")))


# ---------------------------------------------------------------- P15
def loan_risk_level(probability) -> Column:
    p = _c(probability)
    return (F.when(p < LOAN_LOW_BELOW, F.lit("LOW"))
            .when(p < LOAN_MEDIUM_BELOW, F.lit("MEDIUM"))
            .when(p.isNotNull(), F.lit("HIGH")))


def loan_recommendation(probability) -> Column:
    level = loan_risk_level(probability)
    out = F.lit(None).cast("string")
    for k, text in LOAN_RECOMMENDATION.items():
        out = F.when(level == k, F.lit(text)).otherwise(out)
    return out


# ---------------------------------------------------------------- P16
def round_half_up(col, digits: int) -> Column:
    """Our stated rounding rule: half away from zero on the decimal value."""
    return F.round(_c(col), digits)


def percent_1dp(probability) -> Column:
    return F.round(_c(probability) * 100, 1)


# ---------------------------------------------------------------- P21
def status_badge(status) -> Column:
    s = F.lower(F.coalesce(_c(status), F.lit("")))
    return (F.when(s.isin("completed", "success"), F.lit("success"))
            .when(s.isin("failed", "error"), F.lit("error"))
            .when(s == "processing", F.lit("info"))
            .otherwise(F.lit("warning")))


# ---------------------------------------------------------------- P22
# The subjects and bodies of the notices below.
def report_notification(status, filename, report_id, record_count, error=None, event=None,
                        prefix: str = "[reports]") -> Column:
    """Subject and body text for one pipeline outcome, as a struct; ``event``
    is the failed event's JSON text."""
    ok = F.coalesce(_c(status) == F.lit("processed"), F.lit(False))
    subject = F.when(ok, F.format_string(f"{prefix} Report Processed: %s", _c(filename))) \
        .otherwise(F.lit(f"{prefix} Report Processing FAILED"))
    body_ok = F.format_string(
        "Report successfully processed.\n\nFile:         %s\nReport ID:    %s\n"
        "Record count: %s\nStatus:       %s",
        _c(filename), _c(report_id).cast("string"), _c(record_count).cast("string"), _c(status))
    err = F.coalesce(_c(error), F.lit("Unknown error")) if error is not None else F.lit("Unknown error")
    said = F.coalesce(_c(event), F.lit("{}")) if event is not None else F.lit("{}")
    body_fail = F.format_string("Report processing failed.\n\nError: %s\nEvent: %s", err, said)
    return F.struct(subject.alias("subject"), F.when(ok, body_ok).otherwise(body_fail).alias("message"))


def incident_alert_text(record_json) -> Column:
    return F.concat(F.lit("High severity incident: "), _c(record_json))


# ---------------------------------------------------------------- P23
def basename(path) -> Column:
    """Last '/'-separated segment of a path or key."""
    return F.element_at(F.split(_c(path), "/"), -1)


def incident_log_key(incident_id) -> Column:
    return F.concat(F.lit("log-"), _c(incident_id).cast("string"), F.lit(".json"))


def date_prefix(iso_text) -> Column:
    return F.substring(_c(iso_text), 1, 10)


# ---------------------------------------------------------------- P24 / P25
def to_json_line(*cols) -> Column:
    return F.to_json(F.struct(*cols) if cols else F.struct("*"))


def content_id(*cols) -> Column:
    """Reproducible id from content (use ``F.uuid()`` when randomness is wanted)."""
    return F.sha2(F.to_json(F.struct(*cols)), 256)
