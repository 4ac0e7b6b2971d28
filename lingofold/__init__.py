"""lingofold: multilingual text and embedding analytics as Spark DataFrame jobs."""
