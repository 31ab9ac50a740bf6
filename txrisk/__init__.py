"""txrisk: risk scoring of payment transfers as Spark DataFrame jobs."""
