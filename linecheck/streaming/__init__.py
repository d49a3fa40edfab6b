"""The inspection on a stream of files."""
