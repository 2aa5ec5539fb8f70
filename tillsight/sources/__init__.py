"""Where the star schema comes from and where it is written to."""
