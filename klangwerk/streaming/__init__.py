"""klangwerk streaming."""
