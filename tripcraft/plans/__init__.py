"""End-to-end jobs (batch, event path, KPI job) and the registered queries."""
