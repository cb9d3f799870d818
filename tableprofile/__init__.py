"""Table profiling, data-quality checks and model evaluation as Spark jobs."""
