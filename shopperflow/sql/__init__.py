"""The reports as Spark SQL over registered views, and the functions they need."""
