"""DataFrame operators: admission (S1-S4), silver (R1-R4), gold (A1-A4) and
checks (M1-M11).  Batch or streaming frames alike; no Python per row."""
