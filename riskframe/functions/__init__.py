from riskframe.functions.bins import (
    left_closed_index, right_closed_bin, linspace, sql_float, bucketize_frame,
)
from riskframe.functions.exprs import (
    safe_div, woe_value, risk_band, psi_label, iv_strength, logit_eps, round_doubles,
)

__all__ = [
    "left_closed_index", "right_closed_bin", "linspace", "sql_float", "bucketize_frame",
    "safe_div", "woe_value", "risk_band", "psi_label", "iv_strength", "logit_eps", "round_doubles",
]
