"""Inputs: the snapshot grid and block resolution, the fixture tables, entity scans."""
