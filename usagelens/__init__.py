"""usagelens — subscription-product behaviour analytics on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark SQL / DataFrame expressions (and spark.ml for the churn model).
"""

__version__ = "0.1.0"
