"""larder — a Spark-native retail medallion pipeline.

Bronze CSV/JSON feeds are cleaned into silver Parquet and modelled into a star schema
(product, client, area, store and calendar dimensions; order and out-of-stock facts),
with data-quality jobs for the warehouse contract. Library code never creates a
SparkSession: every function takes DataFrames or a session and returns DataFrames.
"""
