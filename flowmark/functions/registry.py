"""SQL functions for users' own queries: register(spark), then for instance SELECT period_of(450)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from flowmark.schema import PERIODS

_PERIOD = " ".join(f"when pmod(m, 1440) >= {a} {'and' if a < b else 'or'} pmod(m, 1440) < {b} then '{n}'" for n, (a, b) in PERIODS.items())
FUNCTIONS = {
    "period_of": f"(m int) returns string return case {_PERIOD} end",
    "inverse_s3": "(v double, vf double, kc double, m double, cap double) returns double return least(least(v, vf * 0.99) * kc * power(greatest(power(greatest(vf / greatest(least(v, vf * 0.99), 1), 1.00001), m / 2) - 1, 1e-8), 1 / m), cap)",
    "qvdf_duration": "(dc double, f_d double, n double) returns double return f_d * power(greatest(dc, 0), n)",
    "qvdf_vt2": "(p double, vc double, f_p double, s double) returns double return least(greatest(vc / (1 + f_p * power(greatest(p, 0), s)), 1), vc)",
    "spelled_code": "(x string) returns string return nullif(regexp_replace(trim(x), '\\\\.0+$', ''), '')",
}


def register(spark: SparkSession) -> list[str]:
    """Temporary SQL functions, inlined by the optimizer; returns their names."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name} {body}")
    return sorted(FUNCTIONS)
