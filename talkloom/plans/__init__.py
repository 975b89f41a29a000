"""The steps from a schedule and recordings to answers and reports, and the queries over the driver's tables."""
