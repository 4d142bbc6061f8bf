"""Oracle SQL used to check the Spark results."""
