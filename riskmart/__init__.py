"""Credit-risk medallion datasets and a default model, as set-at-once Spark jobs.

The Spark session is always the caller's: nothing in this package builds or
stops one. Every operator takes DataFrames covering any number of monthly
snapshots and returns a DataFrame; ``snapshot_date`` stays a ``DATE`` column from
end to end.
"""
