"""Table operators: DataFrames in, a DataFrame out, column names as arguments.

None of them runs a job or collects rows, except where its text says so.
"""
