"""End-to-end DataFrame plans (the reference's jobs) and the registry of
queries with their independent SQL oracle."""
