"""Training-data operators: ten corpus operators, their driver queries and SQL."""
