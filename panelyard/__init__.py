"""Panel-table operators on Spark: keyed merges, quality gates, settlement, cursors, calendars, fundamentals.

Every operator takes DataFrames and returns DataFrames.  Key, entity and date columns are parameters, so the
same code serves daily bars, fundamentals, ratio snapshots and instrument tags.  Only verdicts (a handful of
aggregate rows) ever reach the driver.
"""
