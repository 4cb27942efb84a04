"""Sinks: record topics, relational tables, hash stores, versioned state."""
