"""Column expressions: prose rewriting, lexing, code classification, hashing and rates."""
