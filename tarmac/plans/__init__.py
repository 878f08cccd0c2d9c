"""Business questions, the bulk code replacement, the batch jobs, and the registry of
queries with their independent SQL statements."""
