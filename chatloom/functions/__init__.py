"""See the README."""
