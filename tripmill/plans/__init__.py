"""Report datasets and the staging they share."""
