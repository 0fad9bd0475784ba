"""Reading and writing at the edges: daily feeds, curated data, the warehouse, work tables."""
