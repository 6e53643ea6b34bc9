"""Training-data operators: the ten document operators and their queries."""
