"""The same row operators over files that keep arriving."""
