"""tideline: Spark operators for incremental medallion analytics.

Every operator takes DataFrames and returns DataFrames (or writes a table); Catalyst plans the work.
"""
