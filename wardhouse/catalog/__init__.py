"""The operators as named queries over the TPC-H-like tables, each with the SQL that must give the same rows."""
