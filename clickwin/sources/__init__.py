"""Sources: table scans, the click-log view, the cell store."""
