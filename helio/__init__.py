"""Space-weather analytics as Spark DataFrame transforms."""
