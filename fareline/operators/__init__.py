"""DataFrame-to-DataFrame operators, usable on any table."""
