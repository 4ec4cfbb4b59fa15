"""End-to-end plans (search, legacy search), the registered query set and
their independent SQL oracles."""
