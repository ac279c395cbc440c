"""Customer analytics as Spark jobs over customers, transactions and web sessions."""
