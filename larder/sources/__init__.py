"""Everything that touches a path: snapshots, landing, schemas, serving tables."""
