"""Column expressions and task-local numeric helpers."""
