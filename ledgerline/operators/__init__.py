"""The DataFrame operators."""
