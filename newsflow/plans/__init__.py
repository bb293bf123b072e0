"""End-to-end plans (daily compile, selection) and the named test queries."""
