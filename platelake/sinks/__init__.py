"""Tables to files, and the small tables that describe an output."""
