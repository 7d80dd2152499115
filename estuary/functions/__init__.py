"""Column-level helpers: R data-frame semantics on Spark columns, and fixed lookup values."""
