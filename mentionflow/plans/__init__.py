"""Layer builds, status, reports and the daily run, made of the operators."""
