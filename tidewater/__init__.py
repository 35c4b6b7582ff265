"""tidewater: pipeline operators for PySpark.

Cleaning, validation, deduplication, keyed upserts and deletes, partitioned
lake writes, revenue and count reports, windowed metric alarms, features and
boosted-tree batch scoring, as plain DataFrame transformations, in batch and
(where it makes sense) in Structured Streaming.

Subpackages
-----------
functions   Catalyst column expressions (cleaning, rules, features, contracts)
operators   DataFrame -> DataFrame operators (dedup, changes, reports, alarms, routing, model)
sources     file, envelope and catalog readers
sinks       lake, warehouse, keyed-store, fan-out and audit writers
streaming   Structured Streaming jobs (arrivals, envelopes, landing, dedup, windowed stats)
plans       registered queries over the driver tables, ETL transformations, end-to-end runners

Start with ``tidewater.session.build_session`` and the runners in
``tidewater.plans.runners`` (also ``python -m tidewater --help``).
"""

__version__ = "0.1.0"
