"""Writers: scratch tables, star tables and exported results."""
