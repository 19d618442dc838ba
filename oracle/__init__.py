"""The reports as plain SQL, day by day, to compare the Spark jobs with."""
