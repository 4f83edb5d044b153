"""klangwerk plans."""
