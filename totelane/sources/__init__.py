"""Where the tables come from and where state is kept."""
