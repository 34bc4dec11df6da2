"""Sources and sinks: driver-table fixtures, landed pages, generators, the snapshot store."""
