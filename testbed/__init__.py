"""Stand-in inputs, the query registry and its SQL twins. Not part of the library."""
