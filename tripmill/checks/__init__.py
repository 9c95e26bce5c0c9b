"""The operators bound to the provided tables, with SQL stating the expected results."""
