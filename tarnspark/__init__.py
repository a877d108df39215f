"""tarnspark: listing and review analytics expressed as Spark DataFrame plans."""
