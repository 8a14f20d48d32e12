"""The star schema, the ten analyses and the full run."""
