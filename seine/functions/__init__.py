"""Column functions: URLs, error classes, retry policy, addresses, text."""
