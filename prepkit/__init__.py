"""prepkit: tabular preparation, profiling and model selection as Spark jobs."""
