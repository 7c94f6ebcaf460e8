"""Column-expression helpers and deterministic randomness.

Everything here returns a ``Column`` built from JVM-side functions, so it stays inside
whole-stage codegen. Randomness is derived from md5 of the row key so that the same rows are
drawn on every engine, on every retry of a task and on every re-evaluation of a plan.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWO_POW_32 = float(2 ** 32)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_text(*parts: str | Column | int) -> Column:
    """'a-b-c' text of the parts, the input of the md5-based draws."""
    cols = [F.lit(str(p)) if isinstance(p, int) else col_(p).cast("string") for p in parts]
    return F.concat_ws("-", *cols)


def hash32(*parts: str | Column | int) -> Column:
    """The first 32 bits of md5('p1-p2-...') as a bigint."""
    return F.conv(F.substring(F.md5(hash_text(*parts)), 1, 8), 16, 10).cast("bigint")


def uniform(*parts: str | Column | int) -> Column:
    """Uniform in [0, 1) from the first 32 bits of md5('p1-p2-...')."""
    return hash32(*parts) / F.lit(TWO_POW_32)


DRAWS_PER_HASH = 4


def uniforms(*parts: str | Column | int) -> list[Column]:
    """Four uniforms in [0, 1) from the four 32-bit parts of one md5('p1-p2-...')."""
    h = F.md5(hash_text(*parts))
    return [F.conv(F.substring(h, 1 + 8 * j, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32) for j in range(DRAWS_PER_HASH)]


def uniform_sql(expr: str, nth: str = "0") -> str:
    """The DuckDB / ANSI form of :func:`uniform` (of the ``nth`` of :func:`uniforms`) for an already
    concatenated text expression."""
    return f"(cast(('0x' || substr(md5({expr}), 1 + 8 * ({nth}), 8)) as bigint) / {TWO_POW_32!r})"


# Poisson(1) inverse CDF thresholds: P(X <= k) for k = 0..12 (computed from the definition).
POISSON1_CDF = [math.exp(-1.0) * sum(1.0 / math.factorial(j) for j in range(k + 1)) for k in range(13)]


def poisson1(u: Column) -> Column:
    """Poisson(1) draw from a uniform by inverse CDF (exact for every u < 1 - 2^-32)."""
    expr = F.lit(len(POISSON1_CDF))
    for k in reversed(range(len(POISSON1_CDF))):
        expr = F.when(u < F.lit(POISSON1_CDF[k]), F.lit(k)).otherwise(expr)
    return expr


def poisson1_sql(u: str) -> str:
    branches = " ".join(f"when {u} < {p!r} then {k}" for k, p in enumerate(POISSON1_CDF))
    return f"(case {branches} else {len(POISSON1_CDF)} end)"


def label_map(c: str | Column, mapping: dict[str, int]) -> Column:
    """Literal dictionary lookup with no default (unmapped -> NULL), X5 / P8."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(col_(c) == F.lit(k), F.lit(v)) if expr is None else expr.when(col_(c) == F.lit(k), F.lit(v))
    return expr if expr is not None else F.lit(None)


def _fixed_udf(digits: int):
    @F.pandas_udf(T.StringType())
    def fmt(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None or v != v else format(float(v), f".{digits}f"))
    return fmt


_FIXED_UDFS: dict = {}


def fixed_decimals(c: str | Column, digits: int = 4) -> Column:
    """Python ':.{digits}f' formatting; NULL stays NULL.

    Python rounds the exact binary value (5.19225 is stored just below the tie and prints 5.1922),
    whereas Spark's ``format_string`` starts from the shortest decimal form and rounds half up
    (5.1923). To print exactly what the reference prints, the digits come from Python's formatter
    in an Arrow-batched pandas UDF; it is meant for report-sized outputs, not row-level hot paths.
    """
    if digits not in _FIXED_UDFS:
        _FIXED_UDFS[digits] = _fixed_udf(digits)
    return _FIXED_UDFS[digits](col_(c).cast("double"))
