"""End-to-end plans: the gate run, the gold release, the feeds used by the query suite."""
