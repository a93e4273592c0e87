"""weftline: firmographic lead analytics and training-data operators as Spark jobs."""
