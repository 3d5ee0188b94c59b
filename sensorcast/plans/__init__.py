"""Registered queries (for the driver contract) and the composed jobs."""
