"""Climate analytics for daily weather-station observations, written as Spark jobs."""
