"""City climate and utility-consumption analytics as plain Spark jobs."""
