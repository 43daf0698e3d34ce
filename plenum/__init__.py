"""plenum: deliberation analytics as Spark DataFrame plans."""
