"""tandem: courier-pooling reporting marts on Spark DataFrames.

Layout
------
sources/    table catalogue, readers, the mart sink, and the adapter that turns
            the driver's test tables into the delivery domain tables
functions/  column-level helpers (dates and zones, range buckets, text, zone area)
operators/  DataFrame -> DataFrame building blocks (windows, rollups, joins)
plans/      the eight marts and the job that builds them in order
"""

__all__ = ["session"]
