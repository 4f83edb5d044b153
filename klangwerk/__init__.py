"""klangwerk: pronunciation lexicons, rhyme indexes and corpus operators on Spark."""
