"""What the registered queries are checked against."""
