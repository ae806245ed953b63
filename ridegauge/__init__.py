"""ridegauge: public-transport occupancy reports as PySpark jobs.

Routes and trips in, reports out.  ``plans`` holds the reports, each a function from
DataFrames to a DataFrame; ``streaming`` keeps the same reports up to date over streams.
"""
