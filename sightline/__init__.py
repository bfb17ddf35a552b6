"""sightline: incident analytics as DataFrame-to-DataFrame Spark jobs."""
