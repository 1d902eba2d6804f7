"""The jobs: source tables in, mart tables out."""
