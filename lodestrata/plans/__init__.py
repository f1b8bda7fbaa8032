"""Registered queries: each operator on the test tables, with the SQL it must agree with."""
