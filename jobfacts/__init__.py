"""One-row-per-job fact table for field-service operations, built on Spark DataFrames.

Sub-packages:

* ``sources``    -- readers for the input relations (and the adapters that let the
                    driver's test tables play those roles)
* ``functions``  -- Column-level helpers: code decoding, label normalisation, zone and
                    decimal-hour arithmetic, flags
* ``operators``  -- DataFrame-in / DataFrame-out building blocks: the job spine, the
                    per-job rollups (branches), range join, latest-with-dedupe
* ``plans``      -- the assembled fact (one row per job), key checks, sink
"""

__all__ = ["constants", "session"]
