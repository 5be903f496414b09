"""Hospital-capacity analytics on Spark: bronze files to occupancy, peers and pressure factors."""
