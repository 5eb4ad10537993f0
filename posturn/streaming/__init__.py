"""Structured Streaming wiring of the same operators.

* :mod:`.sources` -- broker (Kafka) source options and a file twin used in tests.
* :mod:`.queries` -- the validation stream (stage A, ``foreachBatch`` fan-out)
  and the turnover stream (stage B with watermark, stage C per batch).
* :mod:`.lateness` -- strict per-store lateness: ``applyInPandasWithState``
  (chainable in one query) or a per-batch parallel scan with a carried clock
  (no per-store task).
* :mod:`.fold` -- a user builder/folder over (key, window) on a stream,
  emitted once per window at close.
"""
