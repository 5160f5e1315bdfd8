"""Compositions of the jobs: builds, the registered query catalog and its SQL oracle."""
