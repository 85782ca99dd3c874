"""DataFrame -> DataFrame operators of the reliability warehouse."""
