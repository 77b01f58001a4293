"""Control monitoring and entity resolution over business master data, as Spark DataFrame operators."""
