"""User-facing jobs: each composes operators into one lazy plan."""
