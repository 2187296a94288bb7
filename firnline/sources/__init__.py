"""Sources, sinks and the versioned trace table."""
