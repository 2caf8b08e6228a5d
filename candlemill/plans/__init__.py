"""Jobs made of several operators; the ones that write tables say so."""
