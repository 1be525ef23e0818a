"""Column -> Column helpers (cleaning, dates, numbers, keys, predicates)."""
