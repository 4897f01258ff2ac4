"""Sources and sinks: raw source schemas, landing of tabular extracts with
validation and an audit log, and adapters over the driver's test tables."""
