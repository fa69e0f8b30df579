"""Column-level building blocks: text in, columns out, no shuffle."""
