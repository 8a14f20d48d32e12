"""Table schemas and the readers that produce staging and star tables."""
