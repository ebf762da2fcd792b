"""Reusable relational operators composed from DataFrame primitives.

* :mod:`~bizlens.operators.ranking` -- first row per key (``min(struct)``),
  tie-keeping extremes and ranks from aggregates joined back to the rows,
  global top-k with deterministic tie-breaks.
* :mod:`~bizlens.operators.aggregate` -- conditional sums, ordered string
  aggregation, discrete percentiles from a (group, value) histogram.
* :mod:`~bizlens.operators.joins` -- point-in-interval join as a day-bucketed
  equi-join.
* :mod:`~bizlens.operators.ids` -- dense 1..n surrogate ids without a global
  window (range partitions, per-partition offsets, reliable checkpoint).
"""
