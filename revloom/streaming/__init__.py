"""Incremental loads over landing folders, as file streams that stop when they have caught up."""
