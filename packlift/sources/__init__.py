"""Input tables: the warehouse layout and reader, live-row filters, and the
derivation of every input from the TPC-H-like test tables."""
