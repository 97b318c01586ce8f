"""Inputs: driver tables, the two trackers' change feeds derived from them,
incremental slices and the partitioned change-file stream source."""
