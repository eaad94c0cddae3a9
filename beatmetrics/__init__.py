"""City-incident analytics as PySpark DataFrame jobs.

Every job is a function of DataFrames that returns one lazy DataFrame; the
caller owns the session, the paths and the action.
"""
