"""Readers and writers for the file formats the analysis starts from and ends in."""
