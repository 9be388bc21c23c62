"""Composed jobs: daily load, warehouse maintenance, analytic queries, benchmark."""
