"""roadflux: road-sensor analytics expressed as Spark DataFrame plans."""
