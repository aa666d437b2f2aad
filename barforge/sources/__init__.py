"""Sources and sinks: the trade topic (Kafka or files), the raw-layer sink
and scans, and inputs derived from the driver's tables."""
