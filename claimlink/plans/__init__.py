"""The pipeline's steps put together, and checks on its results."""
