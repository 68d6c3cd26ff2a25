"""Writers: lake tables and run reports."""
