"""Labels that appear in results."""

# The four match categories.
MATCHED = "matched"
LEDGER_ONLY = "ledger_only"
SETTLEMENT_ONLY = "settlement_only"
DIFFERING = "differing"
CATEGORIES = [MATCHED, LEDGER_ONLY, SETTLEMENT_ONLY, DIFFERING]

# The causes of a difference. UNEXPLAINED is not an accepted one.
PRIOR_DAY_CAPTURE = "timing_prior_day_capture"
AFTER_CUTOFF = "timing_captured_after_cutoff"
NEVER_SETTLED = "missing_never_settled"
SETTLED_TWICE = "settled_twice"
LATE_REFUND = "refund_after_cutoff"
ROUNDING = "rounding"
UNEXPLAINED = "unexplained"
CAUSES = [PRIOR_DAY_CAPTURE, AFTER_CUTOFF, NEVER_SETTLED, SETTLED_TWICE, LATE_REFUND, ROUNDING]

# Fixed value: the label of the report's last row.
TOTAL_LABEL = "TOTAL (should equal the setup-ticket gap)"

# Ledger entry types and the status that earns revenue.
CAPTURE = "capture"
REFUND = "refund"
DELIVERED = "delivered"
