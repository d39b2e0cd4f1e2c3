"""chainstar: dimensional modelling and daily mining economics on Spark.

Layers (one Spark database or path prefix each): ``src`` raw typed loads,
``dim`` dimensions, ``fact`` facts, ``obt`` wide BI tables.

* ``chainstar.functions``  column -> column helpers (cleaning, keys, epochs,
  calendar attributes, exact decimal measures)
* ``chainstar.operators``  DataFrame -> DataFrame operators (staging,
  keep-latest dedupe, default members, key resolution, snapshots, regime
  weighted averages, drill-across, previews, sinks, data checks)
* ``chainstar.sources``    strict CSV / Parquet loads and the stand-in
  sources derived from the driver's tables
* ``chainstar.plans``      the ten models and the build DAG
* ``chainstar.streaming``  incremental daily facts from a live block feed
"""

__version__ = "0.1.0"
