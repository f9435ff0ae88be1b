"""cinestrata: layered title-and-rating analytics written as Spark DataFrame jobs.

Every public function takes and returns :class:`pyspark.sql.DataFrame` objects
(or ``Column`` expressions) and leaves the physical plan to Spark.
"""

__version__ = "0.1.0"
