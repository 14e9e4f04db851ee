"""Sources (S*) and sinks (K*)."""
