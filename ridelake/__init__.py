"""Ride-event analytics in three layers (bronze, silver, gold) on Spark."""
