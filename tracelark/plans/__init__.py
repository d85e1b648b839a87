"""Logs over the test tables, the query catalogue and its SQL counterparts."""
