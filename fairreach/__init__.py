"""Public-transport accessibility analytics as Spark DataFrame jobs."""
