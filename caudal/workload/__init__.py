"""The operators as named queries over the benchmark tables, with SQL to check them."""
