"""The operators run on the test tables, and the SQL their results are checked against."""
