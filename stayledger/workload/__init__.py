"""The operators applied to the sample star-schema tables, with the SQL they are compared with."""
