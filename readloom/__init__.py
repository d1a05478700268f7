"""Read-pileup and run-quality analytics as Spark plans."""
