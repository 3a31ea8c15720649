"""Sources and sinks: JSON landing files, tables, extract windows, fixtures."""
