"""Transit-network analytics as Spark jobs: event logs in, scored networks out."""
