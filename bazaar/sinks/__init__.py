"""Table lifecycle: append, replace, partitioned publish, merge, quarantine, load reports."""
