"""Table sources and sinks: typed survey-table readers, CSV export, fixture views."""
