"""Inputs: fixed source schemas, strict CSV / Parquet loads, and the stand-in
sources derived from the driver's tables (see ``standins``)."""
