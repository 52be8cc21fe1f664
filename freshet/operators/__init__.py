"""Relational operators over river series, networks and grids."""
