"""Star in, DataFrame out: one function per business computation."""
