"""End-to-end plans: the registered queries and the full T1-T5 run."""
