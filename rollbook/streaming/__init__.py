"""Streaming: intentionally empty.

The extracts are nightly batch files over the SIS tables as of one date.  The
source defines no streams, watermarks, windows over event time or state, so
there is no Structured Streaming job to build; a micro-batch version would add
operators the source does not have.
"""
