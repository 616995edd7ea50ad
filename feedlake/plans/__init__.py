"""feedlake.plans."""
