"""The reports, as DataFrame jobs and as Spark SQL."""
