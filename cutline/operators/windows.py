"""Events against a schedule of cutoffs, without multiplying the events.

All window edges of a schedule are known on the driver. They cut the time axis into
buckets that never straddle a window, so events are first reduced to one row per
(key, bucket) and only those rows meet the cutoffs, through a small equi-join.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.functions.calendar import ntz, ntz_text
from cutline.operators.ranking import bucketize, position_of

BUCKET, SALT = "__bucket", "__salt"
BROADCAST_ROWS = 200_000
TREE_EDGES = 256
EPOCH_START = datetime(1970, 1, 1)


@dataclass(frozen=True)
class RoleWindow:
    """Half-open window ``[begin, end)`` that plays ``role`` for one cutoff."""

    cutoff: datetime
    role: str
    begin: datetime
    end: datetime


class Buckets:
    """Time buckets between all edges of a set of windows."""

    def __init__(self, windows: Iterable[RoleWindow]):
        self.windows = [w for w in windows if w.begin < w.end]
        if not self.windows:
            raise ValueError("no window with a positive length")
        self.edges = sorted({e for w in self.windows for e in (w.begin, w.end)})
        self.roles = sorted({w.role for w in self.windows})

    def span(self, t: Column) -> Column:
        """Literal range over all windows; reaches the scan as a pushed filter."""
        return (t >= ntz(self.edges[0])) & (t < ntz(self.edges[-1]))

    def bucket(self, time: str) -> Column:
        """Bucket number of a time inside the span, as a balanced tree of comparisons."""
        def tree(lo: int, hi: int) -> str:
            if hi - lo == 1:
                return str(lo)
            mid = (lo + hi) // 2
            return (f"CASE WHEN `{time}` < {ntz_text(self.edges[mid])} THEN {tree(lo, mid)} "
                    f"ELSE {tree(mid, hi)} END")

        return F.expr(tree(0, len(self.edges) - 1))

    def assign(self, df: DataFrame, time: str) -> DataFrame:
        inside = df.where(self.span(F.col(time)))
        if len(self.edges) <= TREE_EDGES:
            return inside.withColumn(BUCKET, self.bucket(time))
        splits = [(e - EPOCH_START) // timedelta(microseconds=1) for e in self.edges[1:-1]]
        return bucketize(inside, position_of(inside, time), [float(x) for x in splits], BUCKET)

    def membership(self, spark: SparkSession, time: str = "time") -> DataFrame:
        """One row per (bucket, cutoff) with a flag per role, made on the driver."""
        flags: dict[tuple[int, datetime], set[str]] = {}
        for w in self.windows:
            for b in range(bisect_left(self.edges, w.begin), bisect_left(self.edges, w.end)):
                flags.setdefault((b, w.cutoff), set()).add(w.role)
        cells = sorted(flags)
        columns = {
            BUCKET: pa.array([b for b, _ in cells], pa.int32()),
            time: pa.array([c for _, c in cells], pa.timestamp("us")),
        }
        schema = T.StructType().add(BUCKET, T.IntegerType()).add(time, T.TimestampNTZType())
        for r in self.roles:
            columns[f"in_{r}"] = pa.array([r in flags[cell] for cell in cells], pa.bool_())
            schema = schema.add(f"in_{r}", T.BooleanType())
        return spark.createDataFrame(pa.table(columns), schema)

    def expand(self, df: DataFrame, time: str = "time") -> DataFrame:
        """Join rows that carry a bucket to every cutoff whose windows cover that bucket."""
        if len(self.edges) == 2 and len({w.cutoff for w in self.windows}) == 1:
            flags = {f"in_{r}": F.lit(True) for r in self.roles}
            return df.withColumns({time: ntz(self.windows[0].cutoff), **flags}).drop(BUCKET)
        table = self.membership(df.sparkSession, time)
        if len(self.edges) * len({w.cutoff for w in self.windows}) <= BROADCAST_ROWS:
            return df.join(F.broadcast(table), BUCKET).drop(BUCKET)
        # a bucket holds rows of all keys, so the join also takes a salt that follows from the row
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
        salted = df.withColumn(SALT, F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int"))
        copies = table.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return salted.join(copies, [BUCKET, SALT]).drop(BUCKET, SALT)


def interval_join(events: DataFrame, time: str, buckets: Buckets, out: str = "time") -> DataFrame:
    """Every (event, cutoff) pair whose windows contain the event, with the role flags."""
    return buckets.expand(buckets.assign(events.where(F.col(time).isNotNull()), time), out)
