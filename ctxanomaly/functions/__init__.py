"""Column expressions and small task-side numeric helpers."""

from ctxanomaly.functions.expressions import (
    c_factor,
    c_factor_py,
    finite_nonneg,
    flag_abs_gt,
    hash_int,
    hash_int_py,
    hash_unit_py,
    rate,
    row_key,
)

__all__ = [
    "c_factor",
    "c_factor_py",
    "finite_nonneg",
    "flag_abs_gt",
    "hash_int",
    "hash_int_py",
    "hash_unit_py",
    "rate",
    "row_key",
]
