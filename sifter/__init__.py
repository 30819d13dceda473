"""sifter: corpus preparation and news-article classification on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or a Spark ML
estimator), so plans stay lazy and Catalyst sees the whole job.
"""

__version__ = "0.1.0"
