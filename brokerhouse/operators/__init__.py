"""Pure DataFrame operators: numbering, dimensions, history, facts, quality, trade lifecycle."""
