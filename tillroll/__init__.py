"""Customer segmentation analytics as Spark jobs."""
