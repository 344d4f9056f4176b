"""Column-expression helpers (all JVM-side built-ins; no Python UDFs)."""

from tabsift.functions.exprs import (
    count_substring,
    hash_bucket,
    is_fractional,
    is_missing,
    is_non_finite,
    qcol,
    typed_lit,
)

__all__ = [
    "count_substring",
    "hash_bucket",
    "is_fractional",
    "is_missing",
    "is_non_finite",
    "qcol",
    "typed_lit",
]
