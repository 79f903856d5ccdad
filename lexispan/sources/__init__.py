"""Sources and sinks: corpus files/tables, question sets, result files."""
