from riskframe.functions.columns import (
    is_missing, not_missing, round_half_even, safe_div, zero_div,
    hash_uniform, hash_normal, row_key,
)
from riskframe.functions.bands import (
    risk_band, psi_verdict, bmi_class, bp_category, decade, run_name,
)

__all__ = [
    "is_missing", "not_missing", "round_half_even", "safe_div", "zero_div",
    "hash_uniform", "hash_normal", "row_key",
    "risk_band", "psi_verdict", "bmi_class", "bp_category", "decade", "run_name",
]
