"""Transit-shaped views of the general test tables, the registered queries and their SQL twins."""
