"""Rows of a Spark query against rows of DuckDB SQL, as multisets; floats to six decimals."""

from collections import Counter
from decimal import Decimal


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, Decimal)):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


def same(df, cursor) -> None:
    cols = [d[0] for d in cursor.description]
    assert sorted(cols) == sorted(df.columns)
    want = Counter(tuple(norm(v) for v in r) for r in cursor.fetchall())
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    assert got == want, f"Spark only {list((got - want).items())[:3]}, DuckDB only {list((want - got).items())[:3]}"
