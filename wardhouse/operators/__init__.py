"""DataFrame operators: every function takes DataFrames and returns a DataFrame without running a job."""
