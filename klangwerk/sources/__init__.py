"""klangwerk sources."""
