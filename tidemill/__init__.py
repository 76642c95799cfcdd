"""tidemill: table and stream operators written as plain Spark jobs."""
