"""Compositions of operators: dimension jobs (I1, I2), the measurement flow
(I3), ingestion of landed pages (I4), serving reads (J1-J4) and the driver
query catalog."""
