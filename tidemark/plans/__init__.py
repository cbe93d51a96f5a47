"""What to fetch next and how a run ended, as set operations over entity tables."""
