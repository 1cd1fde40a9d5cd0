"""Column builders: everything here is a built-in expression, no Python runs on executors."""
