"""Binary classification analytics on wide numeric tables, as Spark jobs."""
