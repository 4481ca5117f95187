"""strandmill: sequence-context evidence analytics over variant calls, as lazy Spark plans."""
