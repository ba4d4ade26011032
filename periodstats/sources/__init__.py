"""Readers and writers: the TPC-H binding, file landing and BI export."""
