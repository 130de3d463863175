"""The discharge relation and the named queries over it."""
