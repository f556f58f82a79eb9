"""Packages of files, workbooks and documents as DataFrames; sinks and digests."""
