"""Plans: role tables over the driver's data, the daily job, the query registry."""
