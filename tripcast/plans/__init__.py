"""Query catalogue, the registry over the test tables and the SQL oracle."""
