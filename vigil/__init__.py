"""vigil: threat-reporting analytics as Spark DataFrame jobs."""
