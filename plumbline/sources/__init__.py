"""Sources, sinks and the dataset catalog."""
