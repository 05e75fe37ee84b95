"""Whole jobs, and the queries registered with the driver."""
