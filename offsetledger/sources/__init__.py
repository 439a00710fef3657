"""Where records come from and go to: the message log, the commit log, the data files."""
