"""Named datasets a user queries, each a function from tables to one DataFrame."""
