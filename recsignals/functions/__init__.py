from recsignals.functions.expr import (
    micros, safe_ratio, pos_ratio, float_divide, array_mean, array_median, nz_sum,
    finalize,
)

__all__ = ["micros", "safe_ratio", "pos_ratio", "float_divide", "array_mean",
           "array_median", "nz_sum", "finalize"]
