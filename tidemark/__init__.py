"""Change-data analytics on Spark: change events in, keyed tables, watermarks, audit trails and rollups out."""
