"""klangwerk operators."""
