"""The stateless cleaning job on files as they arrive."""
