"""Table-to-table building blocks of the models."""
