"""Expected results as SQL over the test tables, one entry per registered query."""
