"""Sources (text/CSV reports, the events-derived view) and CSV sinks."""
