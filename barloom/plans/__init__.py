"""Reports over the warehouse, and the daily run that fills it."""
