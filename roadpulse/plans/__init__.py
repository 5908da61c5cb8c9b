"""Query registry over the driver tables, and the SQL each query is checked against."""
