"""Sources: change streams, relational tables, offset logs."""
