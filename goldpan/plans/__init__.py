"""Whole jobs: the layer refresh and the registered queries with their reference SQL."""
