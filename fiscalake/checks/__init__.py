"""The library's operators bound to the TPC-H-like test tables, with SQL to compare."""
