"""Reference SQL for the named queries."""
