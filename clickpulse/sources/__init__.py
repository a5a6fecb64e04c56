"""Sources and sinks: Kafka (by name), file stand-ins, tables, replay."""
