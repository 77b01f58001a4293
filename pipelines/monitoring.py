"""What `spark-pipelines` reads: the definitions, with the settings of the specification."""

from pyspark.sql import SparkSession

from mandrel.plans import datasets

spark = SparkSession.active()
datasets.define(spark, spark.conf.get("mandrel.inbox"), spark.conf.get("mandrel.initial"), spark.conf.get("mandrel.matches", None))
