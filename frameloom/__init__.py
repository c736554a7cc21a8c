"""Frame, record and corpus analytics on Spark."""
