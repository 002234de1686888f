"""DataFrame-to-DataFrame operators over the ten tables, request tables and logs."""
