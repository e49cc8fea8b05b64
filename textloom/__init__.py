"""textloom: corpus processing as Spark DataFrame programs."""
