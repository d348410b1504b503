"""The operators registered as queries over the test tables, with their SQL counterparts."""
