"""klangwerk functions."""
