from pitwall.functions.exprs import (  # noqa: F401
    DRS_HALF, DRS_OPEN, DRS_VALID, arg_max, arg_min, bin_floor, drs_open, drs_weight, epoch_seconds, exact_corr,
    guarded_pct, half_up, null_as, safe_corr, step_change,
)
