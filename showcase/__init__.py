"""Stand-in tickets over the test tables, the registered queries and their SQL twins."""
