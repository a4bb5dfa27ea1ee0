"""Zone tables, site registry and state tables."""
