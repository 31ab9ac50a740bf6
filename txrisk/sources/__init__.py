"""Files, catalog tables and the sample transfers."""
