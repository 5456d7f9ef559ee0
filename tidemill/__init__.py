"""ETL and analytics building blocks for Spark.

Every transformation takes DataFrames and returns a DataFrame built from Spark's own
expressions. Only sinks, stream starters and the few steps that write an intermediate
table to the shared folder (see ``tidemill.scratch``) run jobs.
"""
