"""Query catalogue: what the driver and the bench run."""
