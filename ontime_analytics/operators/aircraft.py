"""The aircraft dimension and per-model aggregation of flights.

Dimension (J1): MASTER joined with ACFTREF on the model code, then one row per
tail.  A tail listed twice keeps the greatest (model, code) pair, which is
deterministic (so a re-run task gives the same answer).  Both inputs are
registry-sized; Spark/AQE choose the join strategy and split a skewed code.

Flights -> model (J3/J4): every model query sums per-row measures per model.
Two exact plans, chosen by a size check on the dimension:

* **broadcast** - the dimension has a proven size bound (rows x the widest
  possible row of the fixed-width format) under ``broadcast_max_bytes``: the
  flights are probed against a broadcast hash table and aggregated by model
  with a map-side partial aggregate.  No shuffle on the tail, so a hot tail
  (``NA``, unknown tails) costs nothing extra.
* **co-partitioned shuffle** - otherwise: flights are first aggregated per tail
  (map-side combine collapses a hot tail to one row per task), then joined
  with the dimension.  Both sides come out of an aggregation hash-partitioned
  by ``tail``, so the sort-merge join needs no further exchange, and each side
  has one row per tail, so no join key is skewed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_analytics import schema as S
from ontime_analytics.functions.parse import tail_key

# Widest aircraft row in bytes: tail (5 chars) + code (6) + model (19), each
# at most 4 bytes per character in UTF-8, plus UnsafeRow header/offsets and
# hash-table overhead per entry.
AIRCRAFT_ROW_BYTES_BOUND = (5 + 6 + 19) * 4 + 64 + 32
DEFAULT_BROADCAST_MAX_BYTES = 128 * 1024 * 1024


def aircraft_dimension(master: DataFrame, model_lookup: DataFrame) -> DataFrame:
    """(tail, mfr_model_code, model), one row per tail."""
    joined = master.join(model_lookup, "mfr_model_code", "inner")
    best = F.max(F.struct(F.col("model"), F.col("mfr_model_code"))).alias("best")
    return (joined.groupBy("tail").agg(best)
            .select("tail", F.col("best.mfr_model_code").alias("mfr_model_code"),
                    F.col("best.model").alias("model")))


def aircraft_rows_bound(master: DataFrame) -> int:
    """Proven upper bound on the rows of :func:`aircraft_dimension`: it has at
    most one row per MASTER line.  Counting the lines is one cheap scan of the
    small registry file, without building the join."""
    return master.count()


@dataclass(frozen=True)
class ModelJoin:
    """How flights meet the aircraft dimension.

    ``aircraft_rows`` is a proven upper bound on the rows of a dimension parsed
    from the fixed-width registry (e.g. :func:`aircraft_rows_bound`), whose rows
    have a known greatest width.  When it is ``None`` the dimension is measured,
    rows and widths, which fits any frame.  ``strategy`` asks for ``'broadcast'``
    or ``'shuffle'``; a broadcast above ``broadcast_max_bytes`` is refused.
    ``None`` broadcasts up to that size and shuffles beyond."""

    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES
    aircraft_rows: int | None = None
    strategy: str | None = None

    def aircraft_bytes(self, aircraft: DataFrame) -> int:
        if self.aircraft_rows is not None:
            return self.aircraft_rows * AIRCRAFT_ROW_BYTES_BOUND
        width = F.lit(64 + 32) + F.octet_length(F.coalesce("tail", F.lit(""))) + F.octet_length(F.coalesce("model", F.lit("")))
        return aircraft.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]

    def use_broadcast(self, aircraft: DataFrame) -> bool:
        if self.strategy not in (None, "broadcast", "shuffle"):
            raise ValueError(f"unknown strategy {self.strategy!r}")
        if self.strategy == "shuffle" or (self.strategy is None and self.broadcast_max_bytes <= 0):
            return False
        size = self.aircraft_bytes(aircraft)
        if self.strategy == "broadcast" and size > self.broadcast_max_bytes:
            raise ValueError(f"the aircraft dimension may take {size} bytes, broadcast_max_bytes is {self.broadcast_max_bytes}")
        return size <= self.broadcast_max_bytes


def aggregate_by_model(flights: DataFrame, aircraft: DataFrame,
                       measures: Mapping[str, Column], join: ModelJoin | None = None,
                       matched: tuple[str, ...] = ()) -> DataFrame:
    """Sum each per-row ``measures`` column per aircraft model.

    Flights without a registry match count under the model ``Unavailable``
    (J3 + P10).  For every name in ``matched`` there is also
    ``matched_<name>``: the same sum over the flights that did match the
    registry (J4, inner-join semantics).  Measures must be non-NULL numbers
    (use 0/1 flags and ``coalesce``)."""
    join = join or ModelJoin()
    names = list(measures)
    keyed = flights.select(tail_key("tail_num").alias("tail"),
                           *[measures[n].cast("long").alias(n) for n in names])
    dim = aircraft.select("tail", "model")
    if join.use_broadcast(aircraft):
        joined = keyed.join(F.broadcast(dim), "tail", "left")
    else:
        # the check said "too big to broadcast": keep it a sort-merge join even
        # if the optimizer's own estimate of the dimension is small
        per_tail = keyed.groupBy("tail").agg(*[F.sum(n).alias(n) for n in names])
        joined = per_tail.join(dim.hint("shuffle_merge"), "tail", "left")
    model = F.col("model")
    sums = [F.sum(n).alias(n) for n in names]
    sums += [F.sum(F.when(model.isNotNull(), F.col(n)).otherwise(F.lit(0))).alias(f"matched_{n}")
             for n in matched]
    label = F.coalesce(model, F.lit(S.UNAVAILABLE_MODEL))
    return joined.groupBy(label.alias("model")).agg(*sums)
