"""The registered queries: rides derived from the test tables, and the same in ANSI SQL."""
