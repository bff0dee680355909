"""Jobs that read and write the tables under one output folder."""
