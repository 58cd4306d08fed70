"""The registered queries: operators applied to the given tables, each with the
same question in SQL to check it against."""
