"""DataFrame operators: validation, merge, history, temporal joins, gold tables."""
