"""Spark jobs over text, web-access logs and click streams.

Every transformation takes and returns DataFrames; sources return one, sinks take one.
The caller owns the session.
"""
