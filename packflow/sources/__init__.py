"""Sources and sinks: driver-table binding, wide CSV panels, result tables."""
