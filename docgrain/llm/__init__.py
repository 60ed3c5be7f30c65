"""Training-data operators: each module holds one operator, ``queries`` its registered queries."""
