"""Land-sales analytics on Spark.

Raw yearly property-sale files are cleaned, given stable identifiers and split
into deduplicated entity tables, published as immutable snapshots, and served
through parametrised reports. Everything is expressed with DataFrames and Spark
SQL; see README.md for the module map.
"""

__version__ = "0.1.0"
