"""The run log kept up to date as runs arrive."""
