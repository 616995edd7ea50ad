"""feedlake.streaming."""
