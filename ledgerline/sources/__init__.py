"""Reading, checking and storing the input tables."""
