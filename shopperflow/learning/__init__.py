"""Customer clusters and the churn model on Spark MLlib."""
