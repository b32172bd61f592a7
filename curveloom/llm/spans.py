"""Columns from arrays of ``kind, start, end`` spans, which count code points, the end exclusive."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int>>"


def in_order(spans: list[tuple[str, int, int]], kinds: Sequence[str]) -> list[dict]:
    """By start, then by kind as listed."""
    rank = {k: n for n, k in enumerate(kinds)}
    return [{"kind": k, "start": s, "end": e} for k, s, e in sorted(spans, key=lambda x: (x[1], rank[x[0]], x[2]))]


def of_kinds(spans: str, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(list(kinds)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def counts(spans: str, kinds: Sequence[str], prefix: str = "n_") -> list[Column]:
    return [F.size(of_kinds(spans, [k])).cast("long").alias(f"{prefix}{k}") for k in kinds]


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping ranges as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out
